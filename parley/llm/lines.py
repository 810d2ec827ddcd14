"""Line dedup: fuzzy lines by MinHash, all in DataFrame operations.

Lines are reduced to distinct ones first, named by 128 bits of hash. Each gets character shingles, one
at every position, hashed to 64 bits. The hashes' range is cut into equal parts; the least hashes of a
part make a band. Lines that share a band form a bucket. All lines of a bucket are compared by the
exact Jaccard similarity of their shingles, except where a chain of lines known to be alike joins
them already. Distributed union-find joins what is similar, and of each component the line
that comes first is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.bind import bound
from parley.llm.common import connected_components, held, joined, materialize, remove, unpacked

#: Characters of a shingle, and what is taken out of a line before.
WIDTH, DROPPED = 5, r"[\s\p{Z}\p{P}\p{S}&&[^\n]]+"
SIMILARITY = 0.8
#: Bands of a signature, as a power of two, and hashes of a band.
BAND_BITS, ROWS = 4, 8
#: Places of a piece of a line, whose shingles are hashed in one method, and pieces hashed so.
PIECE, PIECES = 64, 16
#: Members of a bucket that are all compared with each other at once, and of a tile of a larger bucket.
SMALL, TILE = 4, 1000
#: Distinct lines for each file of the tables that are made of them, and files at least.
FILE_LINES, LEAST_FILES = 20_000, 12
#: Words of 64 bits in a sketch that rules pairs of a large bucket out: so many that sets of a few hundred members hardly meet in a bit.
WORDS = 16


def hashes(line: Column) -> Column:
    """Hashes of a line's character shingles, one at each position and repeats included; a shorter line is one shingle."""
    # four bytes a character, so that a shingle is found by its place and not by counting from the start
    unit = 4
    places = lambda raw: F.sequence(F.lit(1), F.greatest(F.length(raw) - unit * WIDTH + 1, F.lit(1)), F.lit(unit))
    return bound(F.encode(line, "UTF-32"), lambda raw: F.transform(places(raw), lambda i: F.xxhash64(raw.substr(i, F.lit(unit * WIDTH)))))


def shingles(line: Column) -> Column:
    """The distinct ``hashes``."""
    return F.array_distinct(hashes(line))


def hashed(rows: DataFrame, line: str) -> DataFrame:
    """``_all``, a struct of the columns of ``rows``, and ``_hashes``, the ``hashes`` of the text in ``line``.

    Each place of a line has an expression of its own, so that hashes come from generated code; a lambda, which Spark
    interprets, takes several times as long. A step adds the hashes of PIECE places to those before, where the line has
    as many. It names all of its columns twice, without which Spark would merge the steps or write them in one method, too
    long for Java to compile. Lines of more than PIECES pieces are left to the lambda. Don't filter by ``_hashes``: the
    filter would repeat all steps.
    """
    unit = 4
    found = rows.select(held(rows).alias("_all"), F.encode(line, "UTF-32").alias("_raw"))
    count = F.greatest((F.length("_raw") / unit).cast("int") - WIDTH + 1, F.lit(1))
    found = found.select(F.struct(count.alias("n"), "_all").alias("_all"), "_raw")
    more = F.col("_all").getField("n")
    for k in range(PIECES):
        # as text, since a call for each of a thousand columns takes the driver many seconds
        piece = f"array({', '.join(f'xxhash64(substr(_raw, {unit * i + 1}, {unit * WIDTH}))' for i in range(k * PIECE, (k + 1) * PIECE))})"
        # every line has the first piece; the condition only names a column twice
        made, before = (f"concat(_hashes, {piece})", "_hashes") if k else (piece, "slice(array(0L), 1, 0)")
        found = found.select("_all", "_raw", F.expr(f"case when _all.n > {k * PIECE} then {made} else {before} end").alias("_hashes"))
    inner = F.col("_all").getField("_all")
    every = F.when(F.size("_hashes") >= more, F.slice("_hashes", F.lit(1), more)).otherwise(hashes(inner.getField(line)))
    return found.select(inner.alias("_all"), every.alias("_hashes"))


def pieced(lines: DataFrame, by: list[str]) -> DataFrame:
    """``lines`` as ``by``, which names a line, ``_rest``, all other columns, and ``_hashes``, the ``hashes`` of ``line``."""
    own = lambda c: F.col("_all").getField(c).alias(c)
    rest = F.struct(*[own(c) for c in lines.columns if c not in by])
    return hashed(lines, "line").select(*[own(c) for c in by], rest.alias("_rest"), "_hashes")


def signed(lines: DataFrame, bits: int = BAND_BITS, rows: int = ROWS, by: list[str] | None = None) -> DataFrame:
    """``lines`` with ``keys``, the bands of each ``line``'s signature.

    A band begins with the least hash of a part and takes ``rows`` numbers from there on, of which the
    border to the next part is one. Parts without a hash give none. ``by`` names the columns that tell
    lines apart, best those that ``lines`` is dealt by already; without it, each row gets a number.
    """
    half = 1 << (bits - 1)
    borders = [F.lit(c << (64 - bits)).cast("long") for c in range(-half, half)]
    found = pieced(lines, by) if by else pieced(lines.withColumn("_line", F.monotonically_increasing_id()), ["_line"])
    own = [F.col(c) if by and c in by else F.col("_rest").getField(c).alias(c) for c in lines.columns]
    # each step is a column of its own, so that it is computed once and in generated code
    found = found.select(*own, F.sort_array(F.array_union("_hashes", F.array(*borders))).alias("_sorted"))
    # a border is looked for from every fourth one on, whose places are found first, and not from the start
    step = 4
    found = found.withColumns({f"_at{i}": F.array_position("_sorted", borders[i]).cast("int") for i in range(0, len(borders), step)})
    ends = {i: F.col(f"_at{i + step}") if i + step < len(borders) else F.size("_sorted") + 1 for i in range(0, len(borders), step)}
    found = found.withColumns({f"_from{i}": F.slice("_sorted", F.col(f"_at{i}"), end - F.col(f"_at{i}")) for i, end in ends.items()})
    after = lambda i: F.col(f"_at{i - i % step}") - 1 + F.array_position(f"_from{i - i % step}", borders[i]).cast("int")
    found = found.withColumns({f"_at{i}": after(i) for i in range(len(borders)) if i % step})

    def key(i: int) -> Column:
        at, following = F.col(f"_at{i}"), F.size("_sorted") + 1 if i + 1 == len(borders) else F.col(f"_at{i + 1}")
        return F.when(following > at + 1, F.xxhash64(F.slice("_sorted", at, F.lit(rows + 1))))

    # ``array_compact`` would have Spark interpret all its array is made of, each slice by boxing a whole line's hashes. Nulls go in generated
    # code instead; the lambda, the only thing interpreted, keeps this out of whole-stage code, whose one method would be too long for Java to compile
    null = F.transform(F.array("_at0"), lambda _: F.lit(None).cast("long"))
    return found.select(*lines.columns, F.array_except(F.array(*map(key, range(len(borders)))), null).alias("keys"))


def exploded(docs: DataFrame) -> DataFrame:
    """Of every line that is not blank: ``row`` (names a row by its text) and ``doc_id``, ``at``, ``line``, and ``h1, h2``, the line's hash.

    Lines are in lower case and without white space, punctuation and symbols; those that would have nothing left stay as they are.
    """
    key, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))
    folded = F.regexp_replace(F.lower(text), DROPPED, "")
    lines = F.zip_with(F.split(text, "\n"), F.split(folded, "\n"), lambda raw, left: F.when(left == "", raw).otherwise(left))
    # the row's hash and folded text are made before the lines are exploded, and not again for each of them
    rows = docs.select(F.xxhash64(text).alias("row"), key.alias("doc_id"), lines.alias("lines"))
    # no row is without a line; the outer form is taken since Spark filters before the other one, and folds each text once more for that
    rows = rows.select("row", "doc_id", F.posexplode_outer("lines").alias("at", "line"))
    return rows.where(F.trim("line") != "").select("*", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"))


def distinct_lines(found: DataFrame) -> DataFrame:
    """Each distinct line of ``exploded``: the ``place`` of the first occurrence, their number ``n``, and the line."""
    place = F.struct("doc_id", "at", "row")
    return found.groupBy("h1", "h2").agg(F.min(place).alias("place"), F.count("*").alias("n"), F.first("line").alias("line"))


def sketch(found: Column) -> Column:
    """WORDS words whose bits tell whether an even or odd number of hashes falls on them.

    Sketches differ in at most as many bits as sets differ in members.
    """
    def word(k: int) -> Column:
        own = F.filter(found, lambda h: h.bitwiseAND(F.lit(WORDS - 1)) == k)
        bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 8).bitwiseAND(F.lit(63)).cast("int"))
        return F.aggregate(own, F.lit(0).cast("long"), lambda acc, h: acc.bitwiseXOR(bit(h)))

    return F.struct(*[word(k).alias(f"w{k}") for k in range(WORDS)])


def alike(pairs: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """The ``pairs`` whose lines' Jaccard similarity reaches ``threshold``."""
    one, two = known.select(F.col("id").alias("u"), F.col("line").alias("lu")), known.select(F.col("id").alias("v"), F.col("line").alias("lv"))
    sets = F.struct(shingles(F.col("lu")).alias("u"), shingles(F.col("lv")).alias("v"))
    # texts take less room in shuffles than the hashes, which are made here
    same = bound(sets, lambda x: bound(F.size(F.array_intersect(x.u, x.v)), lambda n: n >= F.lit(threshold) * (F.size(x.u) + F.size(x.v) - n)))
    return pairs.join(one, "u").join(two, "v").where(same).select(*pairs.columns)


def others(members: DataFrame, roots: DataFrame, known: DataFrame, threshold: float, files: int) -> tuple[DataFrame, str]:
    """Pairs, and where they are written, of buckets of more than SMALL lines that no chain of known links joins yet and that may be alike.

    ``roots`` are the components so far. Each line outside the component of its bucket's pivot meets all
    lines of the bucket that are in another component than its own, in tiles. Sizes and sketches rule
    out only what is not alike. ``cu`` and ``cv`` are the pairs' components.
    """
    large = members.where(f"n > {SMALL}").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component")
    pivots = large.where("id = first").groupBy("key").agg(F.first("c").alias("pivot"))
    large = joined(large, pivots, ["key"]).select("key", "id", "n", "c", (F.col("c") == F.col("pivot")).alias("linked"))
    open_ = large.where("not linked").groupBy("key").agg(F.count("*").alias("loose"))
    loose = joined(large, open_, ["key"])
    drawn = bound(shingles(F.col("line")), lambda h: F.struct(F.size(h).alias("size"), sketch(h).alias("s")))
    drawn = known.join(loose.select("id").distinct(), "id").select("id", drawn.alias("drawn"))
    sides = loose.join(drawn, "id").select("key", "id", "c", "linked", "drawn.*", F.ceil(F.col("loose") / TILE).alias("tx"), F.ceil(F.col("n") / TILE).alias("ty"))
    sides, sides_at = materialize(sides, "lines-sides", files)
    last = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    a = sides.where("not linked").select("*", F.pmod(F.xxhash64("id"), "tx").alias("x"), F.explode(last("ty")).alias("y")).alias("a")
    b = sides.select("*", F.pmod(F.xxhash64("id"), "ty").alias("y"), F.explode(last("tx")).alias("x")).alias("b")
    sizes = F.col("a.size") + F.col("b.size")
    near = F.least("a.size", "b.size") >= F.lit(threshold) * F.greatest("a.size", "b.size") - 1e-6
    bits = sum((F.bit_count(F.col(f"a.s.w{k}").bitwiseXOR(F.col(f"b.s.w{k}"))) for k in range(WORDS)), F.lit(0))
    near = near & (bits <= sizes * ((1 - threshold) / (1 + threshold)) + 1e-6)
    met = a.join(b, F.expr("a.key = b.key and a.x = b.x and a.y = b.y and a.c <> b.c and (b.linked or a.id > b.id)") & near)
    pairs, pairs_at = materialize(met.select(F.col("a.id").alias("u"), F.col("b.id").alias("v"), F.col("a.c").alias("cu"), F.col("b.c").alias("cv")).distinct(), "lines-others", files)
    remove(members.sparkSession, sides_at)
    return pairs, pairs_at


def rooted(lines: DataFrame, files: int, threshold: float = SIMILARITY) -> DataFrame:
    """``id`` and ``root`` of each distinct line: lines of one root are joined by a chain of lines whose shingle sets' Jaccard similarity reaches ``threshold``.

    All lines of a bucket that are alike come to have one root. ``lines`` has an ``id``, the ``line`` and
    the ``keys`` of its signature. First each line is compared with its buckets' pivots; then only
    what is still apart.
    """
    spark = lines.sparkSession
    keyed = lines.select("id", F.explode("keys").alias("key"))
    # nearly all bands are of one line, so a join with the others would deal all of them twice
    counted = keyed.withColumn("n", F.count("*").over(Window.partitionBy("key")))
    met, met_at = materialize(counted.where("n > 1"), "lines-met", files)
    # a bucket's pivot is the line that meets most others, over all its buckets: what has been edited in many ways rather than an edit
    meetings = met.groupBy("id").agg(F.sum("n").alias("meetings"))
    pivots = joined(met, meetings, ["id"]).groupBy("key").agg((-F.max(F.struct("meetings", -F.col("id")))["col2"]).alias("first"))
    members, members_at = materialize(joined(met, pivots, ["key"]), "lines-members", files)
    remove(spark, met_at)
    star = members.where("id <> first").select(F.greatest("id", "first").alias("u"), F.least("id", "first").alias("v"))
    few = members.where(f"n between 3 and {SMALL}").select("key", "id")
    each = few.alias("a").join(few.alias("b"), F.expr("a.key = b.key and a.id > b.id")).select(F.col("a.id").alias("u"), F.col("b.id").alias("v"))
    pairs, pairs_at = materialize(star.union(each).distinct(), "lines-pairs", files)
    known = lines.select("id", "line").join(members.select("id").distinct(), "id")
    known, known_at = materialize(known, "lines-known", files)
    edges, edges_at = materialize(alike(pairs, known, threshold), "lines-edges", files)
    remove(spark, pairs_at)
    roots, _ = materialize(connected_components(edges, "lines-cc"), "lines-roots", files)
    remove(spark, edges_at)
    more, more_at = others(members, roots, known, threshold, files)
    between, between_at = materialize(alike(more, known, threshold).select(F.col("cu").alias("u"), F.col("cv").alias("v")), "lines-between", files)
    for path in (members_at, known_at, more_at):
        remove(spark, path)
    higher, _ = materialize(connected_components(between, "lines-cc"), "lines-higher", files)
    remove(spark, between_at)
    first = lines.select("id").join(roots.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("component", "id").alias("node"))
    return first.join(higher, "node", "left").select("id", F.coalesce("component", "node").alias("root"))


def repeated(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """``doc_id``, ``row`` and ``gone``: the places of the lines that go from each row that loses any."""
    spark = docs.sparkSession
    found = exploded(docs)
    lines = signed(distinct_lines(found), by=["h1", "h2"])
    # the number is given once, as the table is written
    lines, lines_at = materialize(lines.withColumn("id", F.monotonically_increasing_id()), "lines")
    # tables of few lines take few files; their rows grow with the lines
    files = lines.count() // FILE_LINES + LEAST_FILES
    roots, roots_at = materialize(rooted(lines, files, threshold), "lines-root", files)
    found_roots = lines.select("id", "h1", "h2", "place", "n").join(roots, "id")
    # what stays of each component; lines that occur once and resemble none need no second look
    stays = found_roots.groupBy("root").agg(F.min("place").alias("stays"), F.sum("n").alias("total")).where("total > 1").drop("total")
    judged, _ = materialize(joined(found_roots, stays, ["root"]).select("h1", "h2", "stays"), "lines-judged", files)
    remove(spark, lines_at)
    remove(spark, roots_at)
    spots = found.select("h1", "h2", "row", "doc_id", "at").join(judged, ["h1", "h2"])
    gone = spots.where(~F.struct("doc_id", "at", "row").eqNullSafe(F.col("stays")))
    return gone.groupBy("doc_id", "row").agg(F.collect_set("at").alias("gone"))


def deduplicate(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """``docs`` with texts that lack the lines whose like comes earlier; the columns stay as they are, ``n_chars`` is counted anew where it exists.

    Lines are what line feeds separate. Two lines are alike if their shingle sets' Jaccard similarity
    reaches ``threshold``, or if a chain of such lines joins them; what comes first, by doc_id, then
    place, stays. Letter case, white space, punctuation and symbols don't count, except in lines of nothing
    else. Blank lines are never compared and always stay. Candidates come from bands, so alike lines at
    the very threshold may be missed with a small probability; lines that share a band are always found. A null text stays null. A null id comes first. Rows that repeat id and text keep the
    same lines. Documents left without a line stay, with an empty text. An empty table gives an empty
    result. Other columns may have any names.
    """
    gone, _ = materialize(repeated(docs, threshold), "lines-gone")
    kept = docs.columns
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(held(docs).alias("doc"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("row"))
    gone = gone.select(F.col("doc_id").alias("of"), F.col("row").alias("of_row"), "gone")
    out = rows.join(gone, rows["id"].eqNullSafe(gone["of"]) & (rows["row"] == gone["of_row"]), "left")
    lines = F.split(F.col("doc").getField("text"), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    left = bound(lines, lambda every: F.transform(stay, lambda i: F.get(every, i)))
    text = F.when(F.col("gone").isNull(), F.col("doc").getField("text")).otherwise(F.array_join(left, "\n"))
    out = out.select("doc", text.alias("text"))
    new = {"text": F.col("text")}
    if "n_chars" in kept:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[new[c].alias(c) if c in new else was for c, was in zip(kept, unpacked("doc", kept), strict=True)])
