"""Line removal against a plain count."""

import pytest
from pyspark.sql import types as T
from text_cases import lower

from ratingloom.llm import line_dedup

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = T.StructType(
    [
        T.StructField("doc", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("n_lines", T.StringType()),
        T.StructField("mask", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("a", T.StringType()),
    ]
)


def key(line):
    return lower(line.strip(WHITE))


def brute(rows, threshold, least):
    held = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            held.setdefault(key(line), set()).add(doc)
    shared = {k for k, docs in held.items() if len(k) >= least and len(docs) >= threshold}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in shared]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(doc, text, "x", "m", "i", "a") for doc, text in rows], SCHEMA)


def ran(spark, rows, threshold=3, least=1):
    got = line_dedup.drop_shared_lines(frame(spark, rows), "doc", "text", threshold, least)
    assert got.columns == ["doc", "text", "mask", "id", "a", "n_lines", "n_dropped"]
    assert all((r["mask"], r["id"], r["a"]) == ("m", "i", "a") for r in got.collect())
    return sorted(((r["doc"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect()), key=str)


def test_shared_lines_go_everywhere(spark, draw, prose):
    common = [prose(6) for _ in range(5)] + ["", "  ", "Été", "été", "ÉTÉ"]
    rows = []
    for doc in range(60):
        lines = [draw.choice(common) if draw.random() < 0.4 else prose(5) for _ in range(draw.randint(1, 9))]
        lines = [draw.choice(["", " ", "\t"]) + (x.upper() if draw.random() < 0.2 else x) + draw.choice(["", "\r", "\x0b "]) for x in lines]
        rows.append((doc, "\n".join(lines)))
    assert ran(spark, rows) == brute(rows, 3, 1)
    assert ran(spark, rows, 2, 4) == brute(rows, 2, 4)


def test_edge_rows(spark):
    text = "a line\n\nanother"
    rows = [(1, None), (2, ""), (3, text), (3, text), (3, "A LINE"), (None, "a line"), (None, "a line"), (4, "x\na line\nx\n"), (5, "\n")]
    assert ran(spark, rows, 3) == brute(rows, 3, 1)
    # three documents, one of them the rows without an id
    assert dict((r[0], r[3]) for r in ran(spark, rows, 3))[4] == 1
    assert ran(spark, rows, 4) == brute(rows, 4, 1)


def test_a_line_counts_once_a_document(spark):
    rows = [(1, "same\n" * 50), (2, "same")]
    assert [r[3] for r in ran(spark, rows, 3)] == [0, 0]


def test_long_text_and_empty_table(spark, prose):
    long = "\n".join([prose(3), "shared"] * 20_000)
    rows = [(1, long), (2, "shared"), (3, "Shared ")]
    assert ran(spark, rows) == brute(rows, 3, 1)
    assert line_dedup.drop_shared_lines(frame(spark, rows).where("doc < 0"), "doc", "text").count() == 0


@pytest.mark.parametrize("least_broadcast", [0, 200_000])
def test_joins_without_a_broadcast(spark, monkeypatch, least_broadcast):
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", least_broadcast)
    rows = [(i, f"license\nown {i}\nLICENSE \nnotice") for i in range(40)]
    assert ran(spark, rows) == brute(rows, 3, 1)


def test_no_python_in_the_plan(spark):
    plan = line_dedup.drop_shared_lines(frame(spark, [(1, "a")]), "doc", "text")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
