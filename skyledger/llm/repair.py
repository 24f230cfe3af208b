"""Repair of conversation structure by a survivor-coalescence Viterbi search.

Turns of a conversation stream through in order. For each state of the wanted
form (optional system turn, then user and assistant by turns) the cheapest edits
so far survive, kept in a tree of backpointers whose nodes count their
references. What no survivor needs goes, chains close up, and as soon as all
survivors share an ancestor the edits before it are told and forgotten. So a
task holds the unresolved end of one conversation, not the conversation. Equal
costs are settled by the whole unresolved ends of the survivors.
"""

from collections import deque
from collections.abc import Iterator
from itertools import chain, zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
_COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
#: States: nothing said yet, the system turn, a user's turn last, an assistant's turn last. The first and last may end.
EMPTY, SYSTEM, USER, ASSISTANT = "0sua"
_NEXT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_FOLLOWS = {"su", "ua", "au"}
#: Rows told in one batch.
_BATCH = 4096

_SPACE = r"\x20\x09-\x0D"
_TOLD = (
    "conv_id {id}, place long, edit string, turn {turn}, fault string, breaks boolean, cost int, role string, text string"
)


class Node:
    """The edits from ``parent`` to here; ``refs`` are the children and survivors that stand on it."""

    __slots__ = ("parent", "label", "refs")

    def __init__(self, parent: "Node | None", label: list[str]):
        self.parent, self.label, self.refs = parent, label, 1


class Survivors:
    """The cheapest edits that lead to each state, and those that are settled."""

    def __init__(self):
        self.root = Node(None, [])
        self.at = {EMPTY: self.root}
        self.cost = {EMPTY: 0}
        self._inserted()

    def _path(self, node: Node) -> list[Node]:
        path = [node]
        while path[-1].parent is not None:
            path.append(path[-1].parent)
        return path[::-1]

    def _before(self, left: tuple[str, str], right: tuple[str, str]) -> bool:
        """Whether the edits to one state and one edit more come first, by their unresolved ends."""
        a, b = (self._path(self.at[state]) for state, _ in (left, right))
        same = 0
        while same < min(len(a), len(b)) and a[same] is b[same]:
            same += 1
        ends = (chain.from_iterable([*(n.label for n in path[same:]), more]) for path, (_, more) in ((a, left), (b, right)))
        for x, y in zip_longest(*ends, fillvalue=""):
            if x != y:
                return x < y
        return False

    def _advance(self, options: dict[str, list[tuple[int, str, str]]]) -> None:
        """Survivors of the options (cost, state before, edit or nothing) for each state."""
        chosen = {}
        for state, ways in options.items():
            best = ways[0]
            for way in ways[1:]:
                if way[0] < best[0] or way[0] == best[0] and self._before(way[1:], best[1:]):
                    best = way
            chosen[state] = best
        costs = {state: best[0] for state, best in chosen.items()}
        # what others can follow up for less, whatever comes, is no survivor
        worst = lambda state, *others: costs[state] > min((costs[o] + more for o, more in others if o in costs), default=costs[state])
        if EMPTY in costs and worst(EMPTY, (ASSISTANT, 3), (USER, 5), (SYSTEM, 4)):
            del chosen[EMPTY], costs[EMPTY]
        if SYSTEM in costs and worst(SYSTEM, (EMPTY, 0), (ASSISTANT, 0), (USER, 2)):
            del chosen[SYSTEM], costs[SYSTEM]
        uses = [state for _, state, _ in chosen.values()]
        now = {}
        for state, (_, source, edit) in chosen.items():
            node = self.at[source]
            if not edit:
                node.refs += 1
                now[state] = node
            elif node.refs == 1 and uses.count(source) == 1 and node is not self.root:
                node.label.append(edit)
                node.refs += 1
                now[state] = node
            else:
                node.refs += 1
                now[state] = Node(node, [edit])
        for node in self.at.values():
            node.refs -= 1
            while not node.refs and node.parent is not None:
                node = node.parent
                node.refs -= 1
        self.at, self.cost = now, costs

    def _inserted(self) -> None:
        """Turns put in after the last row: a user's, an assistant's, or both."""
        more = _COST[INSERT]
        for targets in ((USER, ASSISTANT), (ASSISTANT,)):
            options = {state: [(cost, state, "")] for state, cost in self.cost.items()}
            for target in targets:
                for (source, said), to in _NEXT.items():
                    if to == target and said != "s" and source in self.cost:
                        options.setdefault(to, []).append((self.cost[source] + more, source, INSERT))
            self._advance(options)

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        """One more row: kept, given a role, or deleted; then what may be put in after it."""
        options: dict[str, list[tuple[int, str, str]]] = {}
        for state, cost in self.cost.items():
            options.setdefault(state, []).append((cost + _COST[DELETE], state, DELETE))
            if must_go:
                continue
            for said in "sua":
                to = _NEXT.get((state, said))
                if to is not None and (said == initial or said != "s"):
                    edit = KEEP if said == initial else REROLE
                    options.setdefault(to, []).append((cost + _COST[edit] + truncated, state, edit))
        self._advance(options)
        self._inserted()

    def settled(self) -> list[str]:
        """The edits up to the last common ancestor of all survivors, which becomes the root."""
        survivors = set(map(id, self.at.values()))
        for node in self.at.values():
            while node.parent is not None:
                above = node.parent
                while above.parent is not None and above.refs == 1 and id(above) not in survivors:
                    above.label.extend(node.label)  # a chain closes up
                    node.label, node.parent = above.label, above.parent
                    above = node.parent
                node = above
        out: list[str] = []
        while self.root.refs == 1 and id(self.root) not in survivors:
            node = next(iter(self.at.values()))
            while node.parent is not self.root:
                node = node.parent
            out += node.label
            node.label, node.parent, self.root = [], None, node
        return out

    def finished(self) -> list[str]:
        """The edits that are left, of the cheapest way to end."""
        ends = [s for s in (EMPTY, ASSISTANT) if s in self.cost]
        best = ends[0]
        for state in ends[1:]:
            a, b = self.cost[state], self.cost[best]
            if a < b or a == b and self._before((state, ""), (best, "")):
                best = state
        return list(chain.from_iterable(node.label for node in self._path(self.at[best])))


class Conversation:
    """Rows of one conversation that are not told yet, and the survivors over them."""

    def __init__(self, id_):
        self.id, self.place, self.state = id_, 0, EMPTY
        self.survivors, self.waiting, self.last = Survivors(), deque(), None

    def told(self, edits: list[str]) -> Iterator[tuple]:
        for edit in edits:
            turn = fault = role = breaks = None
            text, cost = "", _COST[edit]
            if edit != INSERT:
                turn, role, text, fault, breaks = self.waiting.popleft()
                cost += edit != DELETE and fault == "truncated"
            if edit in (INSERT, REROLE):
                said = "a" if self.state == USER else "u"
                role = _NAMES[said]
            elif edit == KEEP:
                said = role[:1]
            if edit != DELETE:
                self.state = _NEXT[self.state, said]
            yield self.id, self.place, edit, turn, fault, breaks, cost, role, text
            self.place += 1

    def row(self, turn, role: str, text: str, fault: str | None) -> Iterator[tuple]:
        now = (turn, role, text)
        if fault != "blank" and self.last == now:
            fault = "duplicate"
        breaks = self.last is not None and self.last[1][:1] + role[:1] not in _FOLLOWS
        self.last = now
        self.waiting.append((*now, fault, breaks))
        self.survivors.row(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
        yield from self.told(self.survivors.settled())

    def end(self) -> Iterator[tuple]:
        yield from self.told(self.survivors.finished())


def _repairer(schema: pa.Schema):
    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            for id_, turn, role, text, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.id != id_:
                    if now is not None:
                        out += now.end()
                    now = Conversation(id_)
                out += now.row(turn, role, text, fault)
                if len(out) >= _BATCH:
                    yield made()
                    out = []
        if now is not None:
            out += now.end()
        if out:
            yield made()

    return repair


def _faulty(rows: DataFrame) -> DataFrame:
    """``rows`` and their faults, but for a row that repeats the one just before it in the same turn.

    Blank comes before duplicate, duplicate before truncated. The first turn of each
    text is found by a grouping, so a conversation of any length is spread over tasks.
    """
    blank = ~F.col("text").rlike(f"[^{_SPACE}]")
    ends = F.col("text").rlike(rf"[.!?][{_SPACE}]*\z")
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    marked = rows.withColumns({"blank": blank, "said": F.when(~blank, F.sha2(whole, 256))})
    when = F.struct(F.col("turn").isNotNull().alias("told"), F.col("turn").alias("turn"))
    firsts = (
        marked.where("NOT blank")
        .groupBy(F.col("conv_id").alias("of"), F.col("said").alias("as"))
        .agg(F.min(when).alias("first"), F.count("*").alias("times"))
        .where("times > 1")
        .drop("times")
    )
    again = F.col("first").isNotNull() & (when > F.col("first"))
    fault = F.when(F.col("blank"), "blank").when(again, "duplicate").when(~ends, "truncated")
    return marked.join(firsts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("said") == F.col("as")), "left").select(
        "conv_id", "turn", "role", "text", fault.alias("fault")
    )


def repaired(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The cheapest edits that give every conversation the form of an optional system turn, then user and assistant by turns.

    A row for each edit, in order of ``place`` from 0: ``edit`` (K keep at cost 0,
    R give the role user or assistant at 2, D delete at 3, I insert an empty user's
    or assistant's turn at 2), ``turn``, ``fault`` (blank, duplicate, truncated or
    null), ``breaks`` (the role's initial may not follow that of the row before),
    ``cost``, and ``role`` and ``text`` as they are after the edit, of deleted rows
    as they were. Blank and duplicate rows are deleted; a truncated row that stays
    costs 1 more. Of equal costs the edits that come first in ASCII are taken.

    Rows come in order of turn (null first; ties by role, then text). Null roles and
    texts are one space, so a null text is blank and a null role fits nowhere. Null
    ids are one conversation. A role counts by its first character. Rows alike in
    turn, role and text are duplicates. Conversations without rows have no edits.
    Other columns are not looked at. A text may be of any length.
    """
    rows = conversations.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
    )
    kinds = {f.name: f.dataType for f in rows.schema}
    told = _TOLD.format(id=kinds["conv_id"].simpleString(), turn=kinds["turn"].simpleString())
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return (
        _faulty(rows)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(_repairer(to_arrow_schema(_parse_datatype_string(told))), told)
        .withColumnsRenamed({"conv_id": id_col, "turn": turn_col, "role": role_col, "text": text_col})
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults by crc32 of ``conv_id:turn`` modulo 20; nulls, in that key too, are one space.

    0 drops the row, 1 empties its text, 2 removes its full stops, exclamation and
    question marks, 3 repeats it, 4 makes it the user's.
    """
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    chance = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    return (
        conversations.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), chance.alias("chance"))
        .where("chance <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("chance") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("chance") == 1, "")
            .when(F.col("chance") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.sequence(F.lit(0), (F.col("chance") == 3).cast("int"))).alias("copy"),
        )
        .drop("copy")
    )


def audited(edits: DataFrame, conversations: DataFrame) -> DataFrame:
    """A row for each of ``conversations``: counts of faults, cost, the edits' initials and a digest of what is left.

    A conversation without rows has zeros, no edits and the digest of nothing. One
    conversation's edits and texts become one row here.
    """
    every = edits.unionByName(conversations.select("conv_id").distinct(), allowMissingColumns=True)
    turns = F.max("turn") - F.min("turn") + 1 - F.size(F.collect_set("turn"))
    faults = [F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")]
    told = F.sort_array(F.collect_list(F.when(F.col("edit").isNotNull(), F.struct("place", "edit", "role", "text"))))
    left = F.transform(
        F.filter("told", lambda e: e["edit"] != DELETE), lambda e: F.concat(e["role"], F.lit(":"), e["text"])
    )
    return (
        every.groupBy("conv_id")
        .agg(
            F.coalesce(turns, F.lit(0)).cast("long").alias("gaps"),
            *faults,
            F.count_if("breaks").alias("illegal"),
            F.coalesce(F.sum("cost"), F.lit(0)).cast("long").alias("cost"),
            told.alias("told"),
        )
        .withColumn("audit", F.array_join(F.transform("told", lambda e: e["edit"]), ""))
        .withColumn("repaired_sha256", F.sha2(F.array_join(left, "\n"), 256))
        .drop("told")
    )
