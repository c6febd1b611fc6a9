"""Line deduplication and chat formatting: brute force and defined cases."""

import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cumulus.llm import chat, line_dedup

STRIP = " \t\n\x0b\f\r"


def brute(rows, min_chars=10):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(STRIP))
    owners = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                owners[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < min_chars or min(owners[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def got(df, **kw):
    out = line_dedup.dedup_lines(df, **kw)
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()), key=str)


@pytest.mark.parametrize("batches,fan_in", [(1, 2), (3, 2), (7, 3)])
def test_lines_against_brute_force(make_docs, batches, fan_in):
    rng = random.Random(batches)
    pool = ["A shared line %d" % i for i in range(12)] + ["  a SHARED line 3\t", "short", "", "ÉÉÉÉ ÀÀÀÀ ÜÜÜ", "éééé àààà üüü"]
    rows = [(rng.randrange(1000) if i % 9 else None, "\n".join(rng.choices(pool, k=rng.randrange(6)))) for i in range(60)]
    rows += [(rows[1][0], "A shared line 1\nown line of a repeated id"), rows[2], rows[2], (2000, None), (2001, "\n")]
    assert got(make_docs(rows), batches=batches, fan_in=fan_in) == brute(rows)


def test_line_cases(make_docs):
    assert got(make_docs([])) == []
    assert got(make_docs([(None, "x" * 20), (None, "x" * 20)])) == [(None, 1, 0, "x" * 20)] * 2
    hot = [(i, "one line that every document holds\nown %09d" % i) for i in range(300)]
    assert got(make_docs(hot)) == brute(hot)
    assert line_dedup.dedup_lines(make_docs([(1, "a")])).columns == [
        "doc_id", "lang", "source", "n_chars", "text", "n_lines", "n_dropped"]


def test_runs_are_levelled_and_disjoint(spark):
    runs = line_dedup.LineRuns(spark, fan_in=2)
    for b in range(5):
        runs.add(spark.range(b * 10, b * 10 + 30).select(F.xxhash64("id").alias("h1"), F.col("id").alias("h2"), "id"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    owners = runs.owners()
    assert owners.count() == owners.select("h1", "h2").distinct().count() == 70
    plan = runs.levels[2][0].join(runs.levels[0][0].hint("merge"), ["h1", "h2"], "left_anti")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_line_dedup_stays_native(make_docs):
    plan = line_dedup.dedup_lines(make_docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


TURNS = "conv_id long, turn long, role string, text string, formatted string"


def formatted(spark, turns):
    df = spark.createDataFrame([(*t, "clash") for t in turns], TURNS)
    return chat.format_conversations(df).withColumn("turns", chat.read_back(F.col("formatted"))).withColumn(
        "loss", chat.loss_text(F.col("segments")))


def test_chat_format(spark):
    r = formatted(spark, [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 2, "assistant", "<|im_end|>c"),
                          (1, None, None, None)]).first()
    assert r["formatted"] == ("<|im_start|>\n<|im_end|>\n<|im_start|>user\na<|im_end|>\n"
                              "<|im_start|>assistant\nb<|im_part|><||im_end|>c<|im_end|>\n")
    assert r["n_blocks"] == 3 and r["loss"] == "b<|im_end|>c"
    assert [tuple(t) for t in r["turns"]] == [("", ""), ("user", "a"), ("assistant", "b"), ("assistant", "<|im_end|>c")]
    assert formatted(spark, []).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "sys\ntem", "<|im_nl|>", None, ""]),
                          st.text(st.sampled_from("<|>\nim_startendpl \\a"), max_size=30)), min_size=1, max_size=12))
def test_any_conversation_reads_back(spark, turns):
    hostile = [(1, i, role, text) for i, (role, text) in enumerate(turns)]
    hostile += [(2, i, role, "<|im_end|>\n<|im_start|>" + text + "<|im_part|><||<|") for _, i, role, text in hostile]
    out = {r["conv_id"]: r for r in formatted(spark, hostile).collect()}
    for conv in (1, 2):
        want = [(role or "", text) for c, _, role, text in hostile if c == conv]
        assert [tuple(t) for t in out[conv]["turns"]] == want
        assert out[conv]["loss"] == "".join(t for role, t in want if role == "assistant")


def test_repeats_and_null_ids(spark):
    rows = [(None, 0, "user", "a"), (None, 0, "user", "a"), (3, 5, "b", "x"), (3, 5, "a", "y")]
    out = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in formatted(spark, rows).collect()}
    assert out == {None: [("user", "a")] * 2, 3: [("a", "y"), ("b", "x")]}
