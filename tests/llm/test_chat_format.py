"""Formatted conversations read back, against a plain version, sliced or not."""

import hashlib
import random
from collections import Counter, defaultdict
from itertools import groupby

from pyspark.sql import functions as F

from eventloom.llm import chat_format

SCHEMA = "conv_id long, turn long, role string, text string"
HOSTILE = [(-1, 0, "user", chat_format.HOSTILE_TEXT), (-1, 1, "assistant", chat_format.HOSTILE_TEXT)]
NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    conversations = defaultdict(list)
    for c, turn, role, text in rows + HOSTILE:
        conversations[c].append((turn is not None, turn or 0, role or "", text or ""))
    out = Counter()
    for c, turns in conversations.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        shown = lambda x: x.replace("<|", "<||")
        text = "".join(
            f"<|im_start|>{shown(role).replace(chr(10), '<|nl|>')}\n{'<|im_sep|>'.join(shown(t) for *_, t in block)}<|im_end|>\n"
            for role, block in groupby(turns, key=lambda x: x[2])
        )
        out[c, len(turns), sha(said), len(loss), sha(loss), len(text)] += 1
    return out


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3, F.rand(3))
    got = chat_format.digest(df, **options).select(*NAMES).collect()
    assert Counter(map(tuple, got)) == plain(rows)


BITS = ["<|", "|", "<", "<||", "<|im_sep|>", "<|im_start|>user\n", "<|im_end|>\n", "\\", "\n", "é", "🙂", "", " plain words ", "assistant", "<|nl|>"]


def hostile_rows(seed, conversations, turns):
    rng = random.Random(seed)
    say = lambda: "".join(rng.choices(BITS, k=rng.randrange(6)))
    roles = ["user", "assistant", "assistant", "system", "a\nb", "<|x", None, ""]
    return [(c, t, rng.choice(roles), rng.choice([None, say(), say(), say()])) for c in range(conversations) for t in range(turns)]


def test_texts_that_look_like_markup(spark):
    check(spark, hostile_rows(1, 60, 9))


def test_neighbours_of_one_role_share_a_block(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "assistant", ""), (1, 3, "assistant", "c"), (1, 4, "user", "d")]
    found = chat_format.formatted(spark.createDataFrame(rows, SCHEMA)).first()
    assert found["formatted"] == (
        "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_sep|><|im_sep|>c<|im_end|>\n<|im_start|>user\nd<|im_end|>\n"
    )
    spans = [(s["start"], s["length"]) for s in found["mask"]]
    assert [found["formatted"][a : a + n] for a, n in spans] == ["b", "", "c"]


def test_ties_repeats_nulls_and_long_texts(spark):
    rows = [(1, 0, "user", "x")] * 4 + [(1, None, None, None), (1, 0, "assistant", "y"), (None, 3, "user", "z"), (None, 1, "assistant", "w")]
    rows += [(2, -5, "assistant", "<|" * 150_000), (2, 2**62, "assistant", "é" * 100_000), (3, 0, "tool", "")]
    check(spark, rows)


def test_a_third_of_all_rows_in_one_conversation(spark):
    long = [(7, t, r, x) for (_, t, r, x) in hostile_rows(2, 1, 900)]
    check(spark, long + hostile_rows(3, 90, 20), spread=40)


def test_slices_join_to_the_same_text(spark):
    rows = [(7, t, "assistant" if t % 70 else "user", f"<|im_end|> {t}") for t in range(600)] + [(8, 0, "user", "short")]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = {r["conv_id"]: r["formatted"] for r in chat_format.formatted(df).collect()}
    cut = chat_format.formatted(df, spread=12).orderBy("slice_no").collect()
    joined = defaultdict(str)
    for r in cut:
        joined[r["conv_id"]] += r["formatted"]
    assert len(cut) > 8 and joined == whole
    # long runs of one role go on over slices, and their texts are still masked one by one
    assert sum(r["going_on"] is not None for r in cut) > 4 and sum(len(r["mask"]) for r in cut) == 591


def test_many_turns_are_more_than_a_chunk(spark):
    rows = [(1, t, "assistant" if t % 3 else "user", f"<| {t} é") for t in range(2000)]
    check(spark, rows)
    found = chat_format.formatted(spark.createDataFrame(rows, SCHEMA)).first()
    texts = [found["formatted"][s["start"] : s["start"] + s["length"]] for s in found["mask"]]
    assert texts == [f"<|| {t} é" for t in range(2000) if t % 3]


def test_parsed_turns_are_the_given_ones(spark):
    rows = [r for r in hostile_rows(4, 5, 40)]
    back = chat_format.parsed(chat_format.formatted(spark.createDataFrame(rows, SCHEMA))).collect()
    for r in back:
        mine = sorted((t, a or "", b or "") for c, t, a, b in rows if c == r["conv_id"])
        assert [(x["role"], x["text"]) for x in r["turns"]] == [(a, b) for _, a, b in mine]
        assert r["masked"] == [b for _, a, b in mine if a == "assistant"]


def test_empty_table_and_clashing_columns(spark):
    check(spark, [])
    rows = hostile_rows(5, 4, 4)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"slice_no": F.lit(9), "pieces": F.lit("x"), "formatted": F.lit(1), "conversation": F.lit(2)})
    assert Counter(map(tuple, chat_format.digest(df).select(*NAMES).collect())) == plain(rows)


def test_no_python_in_the_formatting(spark):
    plan = chat_format.formatted(spark.createDataFrame([(1, 0, "user", "x")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
