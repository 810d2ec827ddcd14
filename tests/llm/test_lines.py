"""Line dedup on lines that are made to be alike."""

from __future__ import annotations

import random
import string

from parley.llm import lines


def word(rng, n=4):
    return "".join(rng.choice(string.ascii_lowercase) for _ in range(n))


def kept(spark, found):
    docs = spark.createDataFrame(list(enumerate(found)), "doc_id long, text string")
    return {r["doc_id"] for r in lines.deduplicate(docs).collect() if r["text"]}


def test_large_bucket(spark, monkeypatch):
    """An original resembles each of 200 one-word edits, most of which don't resemble each other; some tiles are small."""
    monkeypatch.setattr(lines, "TILE", 50)
    rng = random.Random(1)
    for _ in range(2):
        words = [word(rng) for _ in range(20)]
        edits = []
        for i in range(200):
            edit = list(words)
            edit[i % 20] = word(rng)
            edits.append(" ".join(edit))
        assert kept(spark, [" ".join(words), *edits]) == {0}


def grams(line):
    return {line[i : i + 5] for i in range(max(1, len(line) - 4))}


def jaccard(a, b):
    a, b = grams(a), grams(b)
    return len(a & b) / len(a | b)


def test_one_letter_edits(spark):
    """Similarities are those of overlapping 5-grams, and lines with one letter changed or put in are found, also without blanks."""
    rng = random.Random(2)
    pairs = []
    for i in range(60):
        line = word(rng, 90) if i % 2 else "".join(word(rng) for _ in range(24))
        at = rng.randrange(3, 10)
        pairs.append((line, line[:at] + "0" + line[at + i % 2 :]))
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", lines.shingles(lines.F.col("a")).alias("x"), lines.shingles(lines.F.col("b")).alias("y"))
    for r in df.collect():
        assert len(set(r["x"]) & set(r["y"])) / len({*r["x"], *r["y"]}) == jaccard(r["a"], r["b"]) >= 0.8
    assert kept(spark, [x for pair in pairs for x in pair]) == {2 * i for i in range(60)}


def test_folding(spark):
    """Lines that differ in case, white space, a carriage return, quotes or dashes are alike; lines of punctuation count as they are."""
    line = "It's what they call a - so to say - well known case"
    like = [line.upper(), line.replace(" ", "\t"), line.replace(" ", "  "), line + "\r", line.replace("'", "’").replace("-", "—"), line.replace(" ", " ")]
    assert kept(spark, [line, *like, "ok then", "OK, then!\r", "---", "***", "---"]) == {0, 7, 9, 10}


def test_repeated_shingles(spark):
    """Lines that differ only in how often shingles repeat have similarity 1 and the same bands."""
    rng = random.Random(3)
    units = [word(rng, 9) for _ in range(20)]
    df = spark.createDataFrame([(u * 3, u * 4) for u in units], "a string, b string")
    signed = [{r["k"]: r["keys"] for r in lines.signed(df.selectExpr("substr(a, 1, 9) as k", f"{c} as line")).collect()} for c in "ab"]
    assert signed[0] == signed[1]
    assert kept(spark, [x for u in units for x in (u * 3, u * 4)]) == {2 * i for i in range(20)}


def test_pieces(spark):
    """Lines hashed in pieces have the hashes that they have as a whole, at all lengths around a piece's and beyond the basic plane."""
    rng = random.Random(4)
    found = ["", "a", *(word(rng, n) for n in (4, 5, 6, 67, 68, 69, 70, 132, 133, 1000)), "".join(rng.choice("aé中𠀀") for _ in range(300))]
    df = spark.createDataFrame(list(enumerate(found)), "id long, line string")
    whole = {r["id"]: r["h"] for r in df.select("id", lines.hashes(lines.F.col("line")).alias("h")).collect()}
    pieces = lines.pieced(df, ["id"]).select("id", "_rest.line", "_hashes").collect()
    assert [r["line"] for r in sorted(pieces)] == found
    assert {r["id"]: sorted(r["_hashes"]) for r in pieces} == {k: sorted(h) for k, h in whole.items()}


def test_folded_once(spark):
    """Spark's filters before an explode don't fold each text again."""
    df = spark.createDataFrame([(1, "A line")], "doc_id long, text string")
    assert lines.exploded(df)._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == 1


def test_bands(spark):
    """Bands are those of a plain loop, and Spark neither interprets what makes them nor puts it in methods that Java leaves uncompiled."""
    rng = random.Random(6)
    df = spark.createDataFrame([(i, word(rng, n)) for i, n in enumerate((1, 5, 9, 30, 100, 400, 2000))], "id long, line string")
    found = lines.signed(df)
    plan = found._jdf.queryExecution()
    assert "filter(array(" not in plan.optimizedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    stages = lines.signed(df)._jdf.queryExecution().debug().codegenToSeq()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000
    hashes = {r["id"]: set(r["h"]) for r in df.select("id", lines.shingles(lines.F.col("line")).alias("h")).collect()}
    borders = [c << 60 for c in range(-8, 8)]
    wanted = []
    for i, found_hashes in sorted(hashes.items()):
        every = sorted({*found_hashes, *borders})
        at = [every.index(b) for b in borders] + [len(every)]
        wanted += [(i, every[a : a + lines.ROWS + 1]) for a, b in zip(at, at[1:]) if b > a + 1]
    bands = spark.createDataFrame(wanted, "id long, band array<long>").select("id", lines.F.xxhash64("band").alias("key"))
    assert sorted((r["id"], k) for r in found.collect() for k in r["keys"]) == sorted(map(tuple, bands.collect()))


def test_hashed_in_rows(spark):
    """Lines are hashed where they are, without being cut into rows that an aggregate puts together, and have the hashes of a plain loop on either side of the longest such line."""
    rng = random.Random(7)
    most = 1024 + 4
    found = [word(rng, n) for n in (3, 70, most - 1, most, most + 1, 2 * most)]
    df = spark.createDataFrame(list(enumerate(found)), "id long, line string")
    plan = lines.signed(df, by=["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Generate" not in plan
    grams_of = spark.createDataFrame([(i, at, line[at : at + 5]) for i, line in enumerate(found) for at in range(max(1, len(line) - 4))], "id long, at long, gram string")
    hashed = grams_of.select("id", "at", lines.F.xxhash64(lines.F.encode("gram", "UTF-32")).alias("h")).orderBy("id", "at").collect()
    for r in lines.pieced(df, ["id"]).collect():
        assert r["_hashes"] == [x["h"] for x in hashed if x["id"] == r["id"]]
