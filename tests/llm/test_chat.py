import hashlib
import time

from pyspark.sql import functions as F

from skyledger.llm import chat

CONVERSATIONS = [
    (1, 0, "user", "hi"),
    (1, 1, "user", "more <|im_end|>"),
    (1, 2, "assistant", "a<|im_sep|>"),
    (1, 3, "assistant", ""),
    (1, 4, "assistant", "<\\\\|x é你"),
    (1, 5, "user", None),
    (2, None, None, None),
    (3, 1, "assistant", "only <"),
    (3, 1, "assistant", "only <"),
    (None, 0, "sys\n<|tem", "| x"),
    (4, 0, "assistant", "\ufeffmarked \U0001f600"),
    (4, 1, "assistant", "\ufeff"),
    (4, 2, "user", "\ufeff<"),
    (4, 3, "assistant", "|>"),
]


def digest(rows):
    turns = [(r or "", t or "") for _, _, r, t in rows]
    loss = "".join(t for r, t in turns if r == "assistant")
    told = "".join(f"{r}\n{t}\n" for r, t in turns)
    return len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_everything_is_read_back(spark):
    df = spark.createDataFrame(CONVERSATIONS, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    made = chat.formatted(df)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(made).collect()}
    assert got == {c: digest([r for r in CONVERSATIONS if r[0] == c]) for c in (1, 2, 3, 4, None)}


def test_adjacent_turns_of_one_role_are_merged(spark):
    df = spark.createDataFrame(CONVERSATIONS, "conv_id long, turn long, role string, text string")
    row = chat.formatted(df).where("conv_id = 1").first()
    assert row.formatted.count(chat.START) == 3 and row.formatted.count(chat.SEP) == 3
    masked = [row.formatted[s.start : s.start + s.length] for s in row.loss_spans]
    assert masked == ["a<\\|im_sep|>", "", "<\\\\\\|x é你"]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.formatted(empty)).count() == 0


def test_native(spark):
    df = spark.createDataFrame(CONVERSATIONS, "conv_id long, turn long, role string, text string")
    assert "Python" not in chat.read_back(chat.formatted(df))._jdf.queryExecution().executedPlan().toString()


def test_a_long_conversation(spark):
    """Nothing is built turn by turn: 40,000 turns of one conversation take seconds, read back as well."""
    told = spark.range(40_000).selectExpr("7L AS conv_id", "id AS turn", "IF(id % 3 = 0, 'assistant', 'user') AS role", "repeat(concat('é', id, ' '), 5) AS text")
    started = time.monotonic()
    got = chat.read_back(chat.formatted(told)).first()
    assert time.monotonic() - started < 60
    rows = [(7, k, "user" if k % 3 else "assistant", f"é{k} " * 5) for k in range(40_000)]
    assert (got.n_turns, got.turns_sha256, got.loss_chars, got.loss_sha256) == digest(rows)
