r"""Line dedup by a segment-partition edit join.

A line is a trimmed piece of a text between ``\n`` that is not empty.  Two lines are
duplicates if they are equal, or within a number of edits that grows with the longer one:
of characters by ``CHARACTERS``, or of tokens (runs of ASCII without white space, single
other characters) by ``TOKENS``.  A line occurrence is dropped if an equal line occurs earlier (by
document id, then text hash and place) or the first occurrence of a near line is earlier
than its own line's first; the earliest of all always stays.

Near lines are found without comparing all pairs.  For a threshold k, each distinct line is cut
into k + 1 segments, indexed by (length rounded down, segment, content): the first half counted
from the line's start, the others from its end, so that a length need not be known exactly.  A
line probes the indexes with those pieces whose shift an alignment within the threshold allows;
by the pigeonhole principle a near line shares one of them.  Lines that share a segment with few
others are paired.  Members of a large bucket are not: they are compared block by block, each
pair in one of the buckets it shares, and only a line's number of links and the earliest of its
near lines come out, so that what is moved grows with the members, not with their pairs.
Candidates are verified by the built-in edit distance with a threshold, which keeps to the
band of 2 k + 1 diagonals (instead of bit vectors; see ``near``), tokens by their codes.

DataFrame functions only.  Defined results: a null text has no line; null ids sort last;
rows that repeat an id
and its text are one document, different texts under one id (or none) are several; a text
of any length is read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import fresh, pin, shuffle_width

#: Edits from so many characters, and from so many tokens, of the longer line.
CHARACTERS = ((8, 1), (32, 2))
TOKENS = ((16, 1), (32, 2), (64, 4))
NEAR_FROM = CHARACTERS[0][0]
Ladder = tuple[tuple[int, int], ...]
#: Rows of the bitmap that sieves lines, the most that is broadcast.
SIEVE = 2**18


def identity() -> list[Column]:
    """rank and key of a document: its id, nulls last, and the hash of its text."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("rank"), F.xxhash64("text").alias("key")]


def occurrences(docs: DataFrame) -> DataFrame:
    """Document (rank, key), place, line and its hash of every line that counts."""
    lines = docs.select(*identity(), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("place", "line"))
    lines = lines.select("rank", "key", "place", F.trim("line").alias("line"), F.xxhash64(F.trim("line")).alias("hash"))
    return lines.filter("line <> ''")


def tokens(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(r"[\x21-\x7E]+|[^\x00-\x7F]"), F.lit(0))


#: A segment to take of a line's tokens or characters: by the number of edits, for the
#: line's own rounded length or (lower = 1) that of its shortest near line, with a shift;
#: ``flags``: the edits, whether a longer line may find it, and whether it finds shorter lines.
SEGMENT = "array<struct<edits:int,lower:int,segment:int,shift:int,flags:int>>"


def _constant(rows: list[tuple[int, int, int, int, bool, bool]]) -> Column:
    names = ("edits", "lower", "segment", "shift", "flags")
    packed = [(*row, row[0] * 4 + found * 2 + finds) for *row, found, finds in rows]
    return F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in packed]).cast(SEGMENT)


def rounded(length: Column) -> Column:
    """A length rounded down to two significant bits below the first: four steps an octave.

    For every class a step is longer than its edits, so that the lengths of a line's near
    shorter lines round to two values at most, those of the longest and of the shortest.
    """
    step = F.call_function("shiftleft", F.lit(1), F.greatest(F.floor(F.log2(length)).cast("int") - 2, F.lit(0)))
    return length - F.pmod(length, step)


def segments(length: Column, ladder: Ladder) -> Column:
    """The line's segments, for each class that a near longer line may be of, and the pieces
    that a near line, no longer than this one, may have as a segment; ``own`` and ``low``: the
    rounded lengths of the line and of its shortest near line.

    Some segment is free of edits, with at most ``i`` edits before the ``i``-th and at most
    ``edits - i`` behind it; a segment is counted from the end that fewer edits can move.
    """
    out = _constant([])
    for least, edits in ladder:
        rows = [(i, shift) for i in range(edits + 1) for shift in range(-min(i, edits - i), min(i, edits - i) + 1)]
        own = [(edits, 0, i, shift, shift == 0, True) for i, shift in rows]
        lower = [(edits, 1, i, shift, False, True) for i, shift in rows]
        out = F.when(length >= least, F.when(F.col("own") == F.col("low"), _constant(own)).otherwise(_constant(own + lower))).otherwise(out)
    longer = [F.when(length.between(least - edits, least - 1), _constant([(edits, 0, i, 0, True, False) for i in range(edits + 1)]))
              .otherwise(_constant([])) for least, edits in ladder]
    return F.concat(out, *longer)


def keys(cut: DataFrame, ladder: Ladder, by_token: bool) -> DataFrame:
    """One row (hash, told, key) per segment of each line; ``cut``: hash, whole, length; ``told``: length and flags.

    The segments are rows before they are cut, so that one short expression, which Spark
    compiles, serves all of them.  Sizes of a line's segments differ by one at most.
    """
    edits = F.lit(0)
    for least, most in ladder:
        edits = F.when(F.col("length") >= least, F.lit(most)).otherwise(edits)
    cut = cut.select("*", rounded(F.col("length")).alias("own"), rounded(F.col("length") - edits).alias("low"))
    rows = cut.select("hash", "whole", "length", "own", "low", F.explode(segments(F.col("length"), ladder)).alias("s"))
    rows = rows.select("hash", "whole", "length", "s", F.expr("if(s.lower = 1, low, own)").alias("of"))
    start, end = (F.expr(f"cast(of * (s.segment + {i}) div (s.edits + 1) as int)") for i in (0, 1))
    behind = F.expr("if(s.segment * 2 > s.edits, length - of, 0)")
    rows = rows.select("hash", "whole", "length", "s", "of", (start + behind + F.col("s.shift") + 1).alias("start"), (end - start).alias("size"))
    piece = (F.slice if by_token else F.substring)("whole", F.col("start"), F.col("size"))
    key = F.xxhash64(F.lit(by_token), "s.edits", "of", "s.segment", piece).alias("key")
    return rows.select("hash", F.expr("length * 32L + s.flags").alias("told"), key)


#: What ``told`` holds, by name.
TOLD = {"length": "cast(told div 32 as int)", "edits": "cast(told div 4 % 8 as int)", "found": "told & 2 = 2", "finds": "told & 1 = 1"}


def coded(split: Column, salt: int) -> Column:
    """:func:`sketch` of a line's tokens."""
    code = lambda t: F.lpad(F.hex(F.pmod(F.xxhash64(F.lit(salt), t), F.lit(2**20)) + 2**16), 8, "0")
    enough = F.size(split) >= TOKENS[0][0] - TOKENS[0][1]
    return F.when(enough, F.decode(F.unhex(F.array_join(F.transform(split, code), "")), "UTF-32"))


def sketch(line: Column, salt: int) -> Column:
    """A line's tokens as one character each, of 2^20, by a hash; null for lines with too few tokens for ``TOKENS``.

    The codes are joined before they are decoded, so that little is interpreted token by token.
    """
    return coded(tokens(line), salt)


#: Sketches of a line; tokens are told apart by 20 bits in each.
SKETCHES = ("a", "b")


#: What is compared of a line: itself, its sketches, and how long they are.
SPELLED = ("line", *SKETCHES, "n_line", "n_tokens")
#: The most tokens that one edit of characters changes: a run of ASCII cut in two by another character.
TOKENS_AN_EDIT = 3


def near(x: Column, y: Column) -> Column:
    """Whether two lines are near; ``x`` and ``y``: structs with the fields ``SPELLED``.

    Edit distances are the built-in banded ones: a band of 2 k + 1 diagonals in compiled
    code.  Bit vectors written as column functions are interpreted, character by character,
    and were hundreds of times slower.  Tokens come first, as there are fewer of them: lines
    whose tokens are farther apart than edits of characters can make them are not near.
    Tokens of equal codes only make lines nearer, so that no near pair is lost; a pair is
    linked wrongly only if both sketches have equal codes of different tokens, about once in 2^40.
    """
    of = lambda c, k: F.levenshtein(x[c], y[c], k) >= 0
    longest = lambda n: F.greatest(x[n], y[n])
    characters, by_token = F.lit(False), F.lit(False)
    for least, edits in CHARACTERS:
        characters = F.when(longest("n_line") >= least, of("line", edits)).otherwise(characters)
    for least, edits in TOKENS:
        by_token = F.when(longest("n_tokens") >= least, of("a", edits) & of("b", edits)).otherwise(by_token)
    edits = max(k for _, k in CHARACTERS)
    alike = F.abs(x["n_line"] - y["n_line"]) <= edits
    told = x["a"].isNotNull() & y["a"].isNotNull()
    return F.when(alike & told, of("a", TOKENS_AN_EDIT * edits) & (by_token | characters)).when(alike, characters).otherwise(told & by_token)


def sieved(lines: DataFrame, wanted: DataFrame, name: str = "hash") -> DataFrame:
    """The lines whose hash ``name`` may be among ``wanted``, so that the others' text is not shuffled.

    A bitmap of the wanted hashes is broadcast, at most ``SIEVE`` rows of 64 bits whatever
    their number.  The more are wanted the more lines pass it; a join by hash has to follow.
    """
    slot, bit = F.pmod(name, F.lit(SIEVE)).alias("slot"), f"cast(shiftrightunsigned({name}, 32) & 63 as int)"
    marks = wanted.groupBy(slot).agg(F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("marks"))
    rows = lines.withColumn("slot", slot).join(F.broadcast(marks), "slot")
    return rows.filter(F.expr(f"getbit(marks, {bit}) = 1")).select(*lines.columns)


#: Lines of an index bucket beyond which its members are compared block by block.
LARGE = 32
#: Lines, and characters, of a block.
BLOCK = 512
BLOCK_CHARACTERS = 2**20


def candidates(lines: DataFrame) -> DataFrame:
    """Rows (key, hash, length, edits, found, finds, n) of buckets in which two lines meet;
    ``lines``: hash, line; ``n``: the rows of the bucket that can be found.

    Characters and tokens one after the other, so that the keys of one are moved at a time,
    and once: what is left of them is small.
    """
    lines = lines.filter(F.length("line") >= NEAR_FROM)
    out = []
    for ladder, by_token, whole, length in ((CHARACTERS, False, F.col("line"), F.length), (TOKENS, True, F.transform(tokens(F.col("line")), lambda t: F.xxhash64(t)), F.size)):
        # As many characters as tokens at least: a test that does not split the line.
        cut = lines.filter(F.length("line") >= ladder[0][0] - ladder[0][1]).select("hash", whole.alias("whole"))
        rows = keys(cut.withColumn("length", length("whole")), ladder, by_token)
        bucket = Window.partitionBy("key")
        counts = {"n": F.count_if(F.expr(TOLD["found"])), "least": F.min("hash"), "most": F.max("hash")}
        met = rows.withColumns({name: of.over(bucket) for name, of in counts.items()}).filter("n > 0 and least <> most")
        out.append(pin(met.select("key", "hash", "n", "told"), "token_candidates" if by_token else "candidates"))
    return out[0].union(out[1]).select("key", "hash", "n", *[F.expr(of).alias(name) for name, of in TOLD.items()])


def small_pairs(found: DataFrame) -> DataFrame:
    """Distinct pairs (x, y) of lines that meet in a bucket of at most ``LARGE`` lines to find."""
    small = found.filter(F.col("n") <= LARGE)
    there = small.filter("found").select("key", F.col("hash").alias("other"), F.col("length").alias("shorter"))
    apart = F.col("length") - F.col("shorter")
    pairs = small.filter("finds").join(there, "key").filter((F.col("hash") != F.col("other")) & apart.between(0, F.col("edits")))
    return pairs.select(F.least("hash", "other").alias("x"), F.greatest("hash", "other").alias("y")).distinct()


def cells(members: DataFrame) -> DataFrame:
    """Cells of two blocks of one bucket: key, x <= y, ``xs``, ``ys``; ``members``: key, hash, ``of`` (a struct).

    Every block meets every block of its bucket, each cell in a row of its own, so that the
    cells of one bucket spread over the tasks and a task holds two blocks at a time.
    """
    counts = members.groupBy("key").agg(F.count("*").alias("n"), F.sum("of.n_line").alias("characters"))
    parts = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("characters") / BLOCK_CHARACTERS)).cast("int")
    dealt = members.join(counts.select("key", parts.alias("parts")), "key").withColumn("part", F.pmod("hash", "parts").cast("int"))
    blocks = pin(dealt.groupBy("key", "parts", "part").agg(F.collect_list("of").alias("of")), "blocks")
    xs = blocks.select("key", F.col("part").alias("x"), F.explode(F.sequence("part", F.col("parts") - 1)).alias("y"), F.col("of").alias("xs"))
    ys = blocks.select("key", F.explode(F.sequence(F.lit(0), "part")).alias("x"), F.col("part").alias("y"), F.col("of").alias("ys"))
    cell, width = ("key", "x", "y"), shuffle_width(members.sparkSession)
    # A number of parts is kept, where parts small in bytes would be merged: these are long to compare.
    return xs.repartition(width, *cell).join(ys.repartition(width, *cell), list(cell))


def block_links(members: DataFrame) -> DataFrame:
    """Per line of large buckets the number of near lines and the earliest ``first`` of them.

    Two lines are compared once, in the least of the large buckets that they share: ``below``
    are those less than this one.
    """
    once = lambda x, y: (F.col("x") < F.col("y")) | (x["hash"] < y["hash"])
    linked = lambda x, y: once(x, y) & ~F.arrays_overlap(x["below"], y["below"]) & near(x, y)
    found = cells(members).select("xs", "ys", F.transform("xs", lambda x: F.transform("ys", lambda y: linked(x, y))).alias("links"))
    firsts = lambda of, who: F.struct(of["hash"].alias("hash"), F.array_compact(who).alias("firsts"))
    by_x = F.zip_with("xs", "links", lambda x, row: firsts(x, F.zip_with("ys", row, lambda y, is_: F.when(is_, y["first"]))))
    by_y = F.transform("ys", lambda y, j: firsts(y, F.zip_with("xs", "links", lambda x, row: F.when(row[j], x["first"]))))
    rows = found.select(F.explode(F.concat(by_x, by_y)).alias("r")).filter(F.size("r.firsts") > 0)
    return rows.select("r.hash", F.size("r.firsts").cast("long").alias("links"), F.array_min("r.firsts").alias("near_first"))


def near_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct lines (hash, first, copies), and of those with near lines their number and the
    earliest of them (hash, links, near_first)."""
    distinct = pin(
        occurrences(docs).groupBy("hash")
        .agg(F.min(F.struct("rank", "key", "place")).alias("first"), F.count("*").alias("copies"), F.first("line").alias("line")),
        "lines",
    )
    found = candidates(distinct.select("hash", "line"))
    pairs = pin(small_pairs(found), "pairs")
    members = pin(found.filter(F.col("n") > LARGE).select("key", "hash").distinct(), "members")
    buckets = members.groupBy("hash").agg(F.array_sort(F.collect_list("key")).alias("buckets"))
    wanted = pairs.select(F.col("x").alias("hash")).union(pairs.select("y")).union(members.select("hash")).distinct()
    wanted = pin(wanted.join(buckets, "hash", "left"), "wanted")
    spelled = sieved(distinct.select("hash", "line", "first"), wanted).join(wanted, "hash")
    sketches = [coded(F.col("split"), salt).alias(name) for salt, name in enumerate(SKETCHES)]
    spelled = spelled.withColumn("split", tokens(F.col("line"))).select("hash", "first", "buckets", "line", *sketches)
    spelled = spelled.select("*", F.length("line").alias("n_line"), F.coalesce(F.length("a"), F.lit(0)).alias("n_tokens"))
    spelled = pin(spelled, "spelled").select("hash", F.struct("hash", "first", "buckets", *SPELLED).alias("of"))
    both = pairs.join(spelled.toDF("x", "a"), "x").join(spelled.toDF("y", "b"), "y")
    # Lines that share a large bucket are compared there.
    apart = ~F.coalesce(F.arrays_overlap("a.buckets", "b.buckets"), F.lit(False))
    links = both.filter(apart & near(F.col("a"), F.col("b")))
    ends = [F.struct(F.col(e).alias("hash"), F.lit(1).cast("long").alias("links"), F.col(o)["first"].alias("near_first")) for e, o in (("x", "b"), ("y", "a"))]
    rows = links.select(F.explode(F.array(*ends)).alias("r")).select("r.*")
    below = F.filter("of.buckets", lambda other: other < F.col("key"))
    rows = rows.union(block_links(members.join(spelled, "hash").withColumn("of", F.col("of").withField("below", below))))
    totals = rows.groupBy("hash").agg(F.sum("links").alias("links"), F.min("near_first").alias("near_first"))
    return distinct.select("hash", "first", "copies"), pin(totals, "links")


def repeated(docs: DataFrame) -> DataFrame:
    """Line hashes with more than one occurrence or a near line: first, links, earlier."""
    known, links = near_links(docs)
    rows = known.join(links, "hash", "left")
    return rows.filter("copies > 1 or links is not null").select(
        "hash", "first", "copies", F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce(F.col("near_first") < F.col("first"), F.lit(False)).alias("earlier"),
    )


def decisions(docs: DataFrame) -> DataFrame:
    """Every line occurrence (rank, key, place) with hash, length, links and what it is: kept, exact or near."""
    known = repeated(docs)
    lines = occurrences(docs).select("rank", "key", "place", "hash", F.length("line").alias("length"))
    joined = lines.join(known, "hash", "left")
    is_first = F.col("first").isNull() | (F.struct("rank", "key", "place") == F.col("first"))
    what = F.when(~is_first, "exact").when(F.col("earlier"), "near").otherwise("kept")
    return joined.select("rank", "key", "place", "hash", "length", F.coalesce("links", F.lit(0)).alias("links"), what.alias("what"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document id: lines that count, those dropped as equal or near, links, characters dropped."""
    counted = decisions(docs).distinct().groupBy("rank").agg(
        F.count("*").alias("n_lines"),
        F.count_if(F.col("what") == "exact").alias("n_exact"),
        F.count_if(F.col("what") == "near").alias("n_near"),
        F.sum("links").alias("n_links"),
        F.sum(F.when(F.col("what") != "kept", F.col("length")).otherwise(0)).alias("n_chars_dropped"),
    )
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    ids = ids.withColumn("rank", F.coalesce("doc_id", F.lit(2**63 - 1)))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return ids.join(counted, "rank", "left").select("doc_id", *map(zero, ("n_lines", "n_exact", "n_near", "n_links", "n_chars_dropped")))


def drop_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the dropped lines; all rows and columns stay, n_chars follows the text."""
    places, of_rank, of_key = fresh(docs, "_gone"), fresh(docs, "_rank"), fresh(docs, "_key")
    gone = decisions(docs).filter("what <> 'kept'").groupBy("rank", "key").agg(F.collect_set("place").alias(places))
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda line, i: ~F.array_contains(places, i))
    drop = F.col(places).isNotNull()
    rank, key = identity()
    gone = gone.withColumnsRenamed({"rank": of_rank, "key": of_key})
    out = docs.withColumn(of_rank, rank).withColumn(of_key, key).join(gone, [of_rank, of_key], "left")
    out = out.withColumn("text", F.when(drop, F.array_join(kept, "\n")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(drop, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
