"""Spelling variants by an index of variable-length grams.

1. Words are counted where the texts are. Rare ones go.
2. Grams of the words are counted, and those in more words than a threshold form
   the dictionary: a frequent gram is too long a list and is extended, a rare one
   is not. The threshold grows so that the dictionary stays small.
3. A word, with a mark for its end, has one gram at each place: the shortest one
   that is rare, or of the greatest length. Whether it is taken depends on its own
   characters alone, so one edit changes only grams that cover its place. The most
   grams that cover one place bound the grams an edit affects.
4. Of a word's grams, rarest first, all but the affected ones are in both words of
   a near pair, in the same order. So lists of as many grams as can be affected and
   one more hold every pair; the lists of the other, more frequent grams need no
   merging. A list is one gram at one place in words of one length.
5. Words of a list are compared. Words of a list that is very long all the same are
   dealt again by what is left when one character goes.
"""

from collections import Counter
from collections.abc import Iterator
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.settle import fetched, first_row, is_empty, settled
from skyledger.llm.shingles import mixed

LEAST_CHARS, LEAST_COUNT = 6, 5
#: One run in DAMAGE of a document loses a character.
DAMAGE = 199
#: How many times as often as a word its form occurs, at least.
RATIO = 5
#: Words that hold a gram before it is extended, at least, and grams in the dictionary (16 bytes each) at most.
FREQUENT, DICTIONARY = 64, 1 << 17
#: Words of a list that are compared with each other; longer lists are dealt by deletions.
CROWD = 256
#: Shortest gram, and longest that fits a code of 7 bytes.
SHORTEST, LONGEST = 2, 7
#: Words counted before they are sent, rows of lists compared at once, and the width to which words are laid side by side.
_COUNTED, _ROWS, _WIDTH = 1 << 18, 1 << 16, 40

_RUN = "[a-zÀ-ÿ]{%d,}"
_END = 1
_EQUAL, _SHORT, _LONG = 0, 1, 2
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _counter(least: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs_of = re.compile(_RUN % least).findall
        counts: Counter[str] = Counter()

        def sent() -> pa.RecordBatch:
            rows = [(w, n) for w, n in counts.items() if n > 0]
            words, times = zip(*rows) if rows else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(times, pa.int64())], ["word", "n"])

        for batch in batches:
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = text.as_py()
                if not value:
                    continue
                runs = runs_of(value.lower() if value.isascii() else value.encode("utf-8").lower().decode("utf-8"))
                counts.update(runs)
                start = zlib.crc32(f"{'' if id_ is None else id_}:".encode())
                for run in set(runs):
                    h = zlib.crc32(run.encode("utf-8"), start)
                    if h % DAMAGE == 0:
                        at, times = h % len(run), runs.count(run)
                        counts[run] -= times
                        if len(run) > least:
                            counts[run[:at] + run[at + 1 :]] += times
                if len(counts) > _COUNTED:
                    yield sent()
                    counts.clear()
        if counts:
            yield sent()

    return count


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT
) -> DataFrame:
    """``word`` and ``n`` of all words of ``least_chars`` code points or more that occur ``least_count`` times or more.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased.
    Where 199 divides the crc32 of ``<id>:<run>`` the run loses one character; a
    null id is written as nothing. Null texts have no words.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    some = texts.mapInArrow(_counter(least_chars), "word string, n long")
    return some.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Words:
    """Words in Latin-1 side by side, each with its end mark, and the codes of their grams."""

    def __init__(self, column: pa.Array, longest: int):
        words = column.to_pylist()
        self.length = np.array([len(w) for w in words], np.int64)
        self.flat = np.frombuffer(b"".join(w + bytes([_END]) for w in words), np.uint8)
        self.end = np.cumsum(self.length + 1)
        self.start = self.end - self.length - 1
        self.word = np.repeat(np.arange(len(words)), self.length)
        # all places but the end marks
        self.place = np.arange(len(self.word)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        self.at = self.start[self.word] + self.place
        padded = np.concatenate((self.flat, np.zeros(LONGEST, np.uint8))).astype(np.int64)
        self.codes = {}
        code = np.zeros(len(self.at), np.int64)
        left = self.length[self.word] - self.place + 1
        for size in range(1, longest + 1):
            code = code | np.where(size <= left, padded[self.at + size - 1], 0) << 8 * (LONGEST - size)
            self.codes[size] = code
        self.left = left


def _gram_counter(longest: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            words = Words(batch.column(0), longest)
            some = [words.codes[size][words.left >= size] for size in range(SHORTEST, longest + 1)]
            grams, n = np.unique(np.concatenate(some), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(n, pa.int64())], ["gram", "n"])

    return count


def gram_dictionary(vocabulary: DataFrame, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of frequent grams in order, and how often each occurs in the words: DICTIONARY at most."""
    total = first_row(vocabulary.agg(F.sum(F.octet_length("word"))))[0] or 0
    over = max(FREQUENT, -(-total * (longest - SHORTEST + 1) // DICTIONARY))
    # fewer than DICTIONARY rows, as these occur more than total / DICTIONARY times each
    found = fetched(
        vocabulary.select("word")
        .mapInArrow(_gram_counter(longest), "gram long, n long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > over)
    )
    grams, n = found["gram"].to_numpy(), found["n"].to_numpy()
    order = np.argsort(grams)
    return grams[order], n[order]


def variable_grams(words: Words, dictionary: tuple[np.ndarray, np.ndarray], longest: int) -> tuple[np.ndarray, ...]:
    """Code, length and frequency (0 if rare) of the gram at each place of each word."""
    grams, n = dictionary

    def often(codes: np.ndarray) -> np.ndarray:
        if not len(grams):
            return np.zeros(len(codes), np.int64)
        at = np.minimum(np.searchsorted(grams, codes), len(grams) - 1)
        return np.where(grams[at] == codes, n[at], 0)

    size = np.full(len(words.at), SHORTEST)
    code = words.codes[SHORTEST].copy()
    weight = often(code)
    for longer in range(SHORTEST + 1, longest + 1):
        grows = np.flatnonzero((size == longer - 1) & (weight > 0) & (words.left >= longer))
        code[grows] = words.codes[longer][grows]
        size[grows] = longer
        weight[grows] = often(code[grows])
    return code, size, weight


def affected(words: Words, size: np.ndarray) -> np.ndarray:
    """For each word, the most grams that one edit can change: those that cover one place."""
    edge = np.zeros(len(words.flat) + 1, np.int64)
    np.add.at(edge, words.at, 1)
    np.add.at(edge, words.at + size, -1)
    cover = np.cumsum(edge)[words.at]
    return np.maximum.reduceat(cover, np.cumsum(words.length) - words.length)


def _named(code: np.ndarray, place: np.ndarray, length: np.ndarray, kind: int) -> np.ndarray:
    key = mixed(code.view(np.uint64) * _GOLD + place.astype(np.uint64))
    return mixed(key * _GOLD + length.astype(np.uint64) * np.uint64(2) + np.uint64(kind)).view(np.int64)


def _listed(column: pa.Array, n: pa.Array, parts: list[tuple[np.ndarray, np.ndarray, int]]) -> pa.RecordBatch:
    """Rows (key, side, word, n) from parts (word number, key, side)."""
    which = np.concatenate([w for w, _, _ in parts])
    side = np.concatenate([np.full(len(w), s, np.int8) for w, _, s in parts])
    take = pa.array(which)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([k for _, k, _ in parts])), pa.array(side), column.take(take), n.take(take)],
        ["key", "side", "word", "n"],
    )


def _indexer(shared, longest: int, least: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The lists of each word: its rarest grams, as many as one edit can change and one more."""
        dictionary = shared.value
        for batch in filter(len, batches):
            words = Words(batch.column(0), longest)
            code, size, weight = variable_grams(words, dictionary, longest)
            most = affected(words, size)
            order = np.lexsort((words.place, mixed(code.view(np.uint64)), weight, words.word))
            rank = np.arange(len(order)) - np.repeat(np.cumsum(words.length) - words.length, words.length)
            some = order[rank <= most[words.word[order]]]
            word, place, code = words.word[some], words.place[some], code[some]
            length = words.length[word]
            long = length > least
            yield _listed(
                batch.column(0),
                batch.column(1),
                [
                    (word, _named(code, place, length, 0), _EQUAL),
                    # grams before an inserted character keep their place, those after it move on
                    (word, _named(code, place, length, 1), _SHORT),
                    (word, _named(code, place + 1, length, 1), _SHORT),
                    (word[long], _named(code[long], place[long], length[long] - 1, 1), _LONG),
                ],
            )

    return index


def _deleted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of words by what is left without one character."""
    for batch in filter(len, batches):
        words = Words(batch.column(0), SHORTEST)
        up = np.full(int(words.length.max(initial=0)) + 1, _GOLD | np.uint64(1))
        up[0] = 1
        up = np.multiply.accumulate(up)
        down = np.uint64(pow(int(_GOLD | np.uint64(1)), -1, 1 << 64))
        value = (words.flat[words.at].astype(np.uint64) + np.uint64(1)) * up[words.place]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value)))
        first = np.cumsum(words.length) - words.length
        before = sums[:-1] - sums[first][words.word]
        after = sums[(first + words.length)][words.word] - sums[1:]
        rest = mixed(before + after * down).view(np.int64)
        whole = mixed(sums[first + words.length] - sums[first]).view(np.int64)
        number = np.arange(len(words.length))
        length = words.length[words.word]
        yield _listed(
            batch.column(0),
            batch.column(1),
            [
                (words.word, _named(rest, words.place, length, 0), _EQUAL),
                (number, _named(whole, np.zeros_like(number), words.length, 1), _SHORT),
                (words.word, _named(rest, np.zeros_like(length), length - 1, 1), _LONG),
            ],
        )


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced character."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    same = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def _near(matrix: np.ndarray, length: np.ndarray, words: list[bytes], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``one_edit`` for many pairs of rows, the first no longer than the second."""
    out = np.zeros(len(i), bool)
    wide = (length[i] > _WIDTH) | (length[j] > _WIDTH)
    for k in np.flatnonzero(wide):
        out[k] = one_edit(words[i[k]], words[j[k]])
    level = np.flatnonzero(~wide & (length[i] == length[j]))
    out[level] = (matrix[i[level]] != matrix[j[level]]).sum(axis=1) == 1
    step = np.flatnonzero(~wide & (length[i] + 1 == length[j]))
    if len(step):
        a, b = matrix[i[step]], matrix[j[step]]
        first = (a != b).argmax(axis=1)
        moved = a[:, :-1] == b[:, 1:]
        out[step] = (moved | (np.arange(_WIDTH) < first[:, None])).all(axis=1)
    return out


def _whole_lists(batches: Iterator[pa.RecordBatch], crowd: int | None) -> Iterator[tuple[bool, pa.Table]]:
    """Rows sorted by key, some lists at a time; (True, rows) for parts of a list of more than ``crowd`` rows."""
    held: pa.Table | None = None
    passing = None  # the list whose rows go by as a crowd
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        if passing is not None:
            more = int(np.searchsorted(held["key"].to_numpy(), passing, side="right"))
            if more:
                yield True, held.slice(0, more)
            held = held.slice(more)
        if len(held) < _ROWS:
            continue
        key = held["key"].to_numpy()
        last = int(np.searchsorted(key, key[-1]))
        if last:
            yield False, held.slice(0, last)
        held, passing = held.slice(last), None
        if crowd is not None and len(held) > crowd:
            yield True, held
            held, passing = held.slice(len(held)), key[-1]
    if held is not None and len(held):
        yield False, held


def _comparer(crowd: int | None):
    """Near pairs, both ways, from rows sorted by (key, side); words of lists over ``crowd`` rows come back without another."""

    def alone(rows: pa.Table) -> pa.RecordBatch:
        none = pa.nulls(len(rows))
        return pa.RecordBatch.from_arrays(
            [rows["word"].combine_chunks(), rows["n"].combine_chunks(), none.cast(pa.binary()), none.cast(pa.int64())],
            ["word", "n", "other", "other_n"],
        )

    def met(rows: pa.Table) -> pa.RecordBatch:
        key, side, n = (rows[c].to_numpy() for c in ("key", "side", "n"))
        column = rows["word"].combine_chunks()
        words = column.to_pylist()
        length = np.array([len(w) for w in words])
        matrix = np.array([w[:_WIDTH] for w in words], f"S{_WIDTH + 1}").view(np.uint8).reshape(len(words), _WIDTH + 1)
        found = [np.empty((2, 0), np.int64)]
        here, step = np.arange(len(key)), 1
        while len(here):
            here = here[here + step < len(key)]
            here = here[key[here] == key[here + step]]
            other = here + step
            fits = (side[here] == side[other]) & (side[here] == _EQUAL) | (side[here] == _SHORT) & (side[other] == _LONG)
            i, j = here[fits], other[fits]
            near = _near(matrix, length, words, i, j)
            found.append(np.stack((i[near], j[near])))
            step += 1
        i, j = np.concatenate(found, axis=1)
        a, b = np.concatenate((i, j)), np.concatenate((j, i))
        return pa.RecordBatch.from_arrays(
            [column.take(pa.array(a)), pa.array(n[a]), column.take(pa.array(b)), pa.array(n[b])],
            ["word", "n", "other", "other_n"],
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for passing, rows in _whole_lists(batches, crowd):
            if passing:
                yield alone(rows)
                continue
            if crowd is not None:
                _, which, members = np.unique(rows["key"].to_numpy(), return_inverse=True, return_counts=True)
                many = pa.array(members[which] > crowd)
                yield alone(rows.filter(many))
                rows = rows.filter(pa.compute.invert(many))
            if len(rows):
                yield met(rows)

    return compare


def _links(rows: DataFrame, crowd: int | None) -> DataFrame:
    return (
        rows.repartition("key")
        .sortWithinPartitions("key", "side")
        .mapInArrow(_comparer(crowd), "word binary, n long, other binary, other_n long")
    )


def near_words(vocabulary: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``word``, ``other`` and ``other_n`` for all near pairs, both ways, of (word, n); words in Latin-1.

    The greatest gram length is one below that of the shortest word, so that no edit
    changes all grams of a word.
    """
    longest = min(least_chars - 1, LONGEST)
    if longest < SHORTEST:
        raise ValueError("words need three characters at least")
    shared = vocabulary.sparkSession.sparkContext.broadcast(gram_dictionary(vocabulary, longest))
    listed = "key long, side byte, word binary, n long"
    met = settled(_links(vocabulary.mapInArrow(_indexer(shared, longest, least_chars), listed), CROWD))
    crowd = met.where("other IS NULL").select("word", "n").distinct()
    more = _links(crowd.mapInArrow(_deleted, listed), None)
    return (
        met.where("other IS NOT NULL")
        .union(more)
        .repartition("word")
        .groupBy("word", "other")
        .agg(F.first("other_n").alias("other_n"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of words with a form, each round following twice as many forms. Counts grow, so none meets itself."""
    now = settled(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        then = now.select(F.col("word").alias("via"), F.col("root").alias("further"))
        moved = settled(now.join(then, F.col("root") == F.col("via"), "left").select("word", "root", "further"))
        if is_empty(moved.where("further IS NOT NULL")):
            return now
        now = moved.select("word", F.coalesce("further", "root").alias("root"))


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word of ``word_counts``.

    Near words differ by exactly one inserted, deleted or replaced code point. The
    form is the near word of greatest count (ties: the least by code points) if it
    occurs ``ratio`` times as often or more, the root the last of the forms' forms.

    Null and empty texts have no words; ids may be null or repeat. Other columns
    are not looked at. A table without words gives no rows. A word may be of any length.
    """
    counted = word_counts(docs, id_col, text_col, least_chars, least_count)
    vocabulary = settled(counted.select(F.encode("word", "ISO-8859-1").alias("word"), "n"))
    near = near_words(vocabulary, least_chars).groupBy(F.col("word").alias("of")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("top")
    )
    often = -F.col("top.less") >= F.col("n") * ratio
    forms = settled(
        vocabulary.join(near, F.col("word") == F.col("of"), "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, F.col("top.other")).alias("form"),
            F.when(often, -F.col("top.less")).alias("form_n"),
        )
    )
    roots = _roots(forms).select(F.col("word").alias("of"), "root")
    plain = lambda c: F.decode(c, "ISO-8859-1")
    return forms.join(roots, F.col("word") == F.col("of"), "left").select(
        plain("word").alias("word"),
        "n",
        "n_near",
        plain("form").alias("form"),
        "form_n",
        plain(F.coalesce("root", "word")).alias("root"),
    )
