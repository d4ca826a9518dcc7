"""De-duplication on business keys, and reports about duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.operators.shape import col_of, cols_of, has_column
from rollcall.session import pin

LINEAGE = ("source_year", "source_file")
# Words of 64 bits per row of a sieve, and in a whole one (64 MB, the most the driver collects
# and a task is sent; what passes through the driver is held there several times over).
BLOCK = 2**10
MOST_WORDS = 2**23
# Rows below which one plain pass is cheaper than the jobs of a sieve.
FEW_ROWS = 2**20
# Columns besides key and lineage from which on rows cost more to move than to read again.
WIDE = 16


def total_order(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Newest file first, then every remaining column, so that any two different rows
    with the same key have a defined order."""
    keyed = {k.lower() for k in keys}
    lineage = [c for c in LINEAGE if has_column(df, c) and c not in keyed]
    rest = [c for c in df.columns if c.lower() not in keyed and c.lower() not in lineage]
    return [F.desc_nulls_last(c) for c in lineage] + [col_of(c).asc_nulls_last() for c in rest]


def _unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each behind as many underscores as it takes to be no column of ``df``."""
    free = []
    for name in names:
        while has_column(df, name):
            name = f"_{name}"
        free.append(name)
    return free


def _hashed(keys: Sequence[str]) -> list[Column]:
    return [F.xxhash64(*cols_of(keys))] if keys else []


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``; NULL keys are equal to each other.

    The rank filter becomes a group limit below the exchange: a task sends on at most
    one row per key, however many copies of a hot key it holds.  The hash ahead of the keys
    splits no key; it lets the sorts tell most rows apart without comparing text.
    """
    ranked = Window.partitionBy(*_hashed(keys), *cols_of(keys)).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def _mark(digest: Column) -> Column:
    """Two bits of a word, taken from the upper half of a hash."""
    one = F.lit(1).cast("long")
    bits = [F.shiftrightunsigned(digest, at).bitwiseAND(F.lit(63)).cast("int") for at in (32, 38)]
    return F.call_function("shiftleft", one, bits[0]).bitwiseOR(F.call_function("shiftleft", one, bits[1]))


def _has(word: Column, digest: Column) -> Column:
    """Whether both bits are set, naming the word once: filters build each mention anew."""
    return F.bitwise_not(word).bitwiseAND(_mark(digest)) == 0


class Sieve:
    """A bitmap of hashes that grows with their number and is sent to every task.

    It lets every marked hash through, and about one of twenty others, or of a hundred with 4
    hashes ``a_word``.  Beyond ``MOST_WORDS`` words it lets more of the others through, and the
    exact step behind it has more to do.
    """

    def __init__(self, digests: DataFrame, a_word: int = 8):
        """``digests`` has the column ``_digest`` and may have ``_mark``, a second hash that
        sets the bits of the word the first one finds; it is read twice, so pin it."""
        n = digests.count()
        self.empty = n == 0
        self.words = BLOCK
        while self.words * a_word < n and self.words < MOST_WORDS:
            self.words *= 2
        marked = F.col("_mark" if has_column(digests, "_mark") else "_digest")
        marks = digests.select(self._word(F.col("_digest")).alias("_word"), _mark(marked).alias("_marks"))
        every = digests.sparkSession.range(self.words).select(
            F.col("id").alias("_word"), F.lit(0).cast("long").alias("_marks")
        )
        filled = marks.unionByName(every).groupBy("_word").agg(F.bit_or("_marks").alias("_marks"))
        block = F.shiftright("_word", BLOCK.bit_length() - 1).alias("_block")
        blocks = filled.groupBy(block).agg(F.array_sort(F.collect_list(F.struct("_word", "_marks"))).alias("_placed"))
        self.blocks = pin(blocks.select("_block", F.col("_placed._marks").alias("_words")), "sieve")

    def _word(self, digest: Column) -> Column:
        """The words are a power of two."""
        return digest.bitwiseAND(F.lit(self.words - 1).cast("long"))

    def passes(self, digest: Column, mark: Column | None = None) -> Column:
        """True for marked hashes and few others.

        The bitmap is a scalar subquery here: a filter by it goes below projections, so that
        the columns of rows that fail are not built, which a join would not do.  A filter
        builds the hashes anew for each mention, ``digest`` once and ``mark`` twice.
        """
        placed = self.blocks.agg(F.array_sort(F.collect_list(F.struct("_block", "_words"))).alias("_placed"))
        bitmap = placed.select(F.flatten("_placed._words")).scalar()
        return _has(F.get(bitmap, self._word(digest).cast("int")), digest if mark is None else mark)

    def divide(self, df: DataFrame, digest: Column, mark: Column | None = None) -> tuple[DataFrame, DataFrame]:
        """(rows that fail, rows that pass), by joins.

        Each hash is built once a row: the join is an inner one, as every word is in the
        bitmap, and unlike a semi join it keeps the projection with the hashes below it.
        """
        first, second, block, words = _unused(df, "_digest", "_mark", "_block", "_words")
        hashed = df.withColumns({first: digest} if mark is None else {first: digest, second: mark})
        word = self._word(F.col(first))
        here = F.shiftright(word, BLOCK.bit_length() - 1) == F.col(block)
        placed = hashed.join(F.broadcast(self.blocks.toDF(block, words)), here)
        marked = F.col(first if mark is None else second)
        passes = _has(F.get(words, word.bitwiseAND(F.lit(BLOCK - 1)).cast("int")), marked)
        return tuple(placed.filter(test).select(*cols_of(df.columns)) for test in (~passes, passes))


def _recurring(digests: DataFrame) -> Sieve:
    """A sieve of the hashes in ``_digest`` that occur more than once."""
    counted = digests.groupBy("_digest").agg(F.count("*").alias("_n"))
    return Sieve(pin(counted.filter("_n > 1").select("_digest"), "recurring"), a_word=4)


def split_recurring(df: DataFrame, keys: Sequence[str], digest: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows whose key occurs once, the other rows and few of the first kind).

    Hashes of the keys are counted, and those that recur are marked in a sieve.  Neither
    part is shuffled.  ``df`` is read three times, first by its keys alone, or by ``digest``
    where it has their hash; where it is more than a scan, pin it.
    """
    digest = F.xxhash64(*cols_of(keys)) if digest is None else digest
    recurring = _recurring(df.select(digest.alias("_digest")))
    return (df, df.limit(0)) if recurring.empty else recurring.divide(df, digest)


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per business key, chosen by a total order (same result on every run)."""
    return first_per_key(df, keys, order or total_order(df, keys))


def dedup_sieved(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """:func:`dedup` for tables with few copies and a costly shuffle.

    Only rows of recurring keys are ordered; the others are passed on from the scan, neither
    sorted nor shuffled, at the price of reading the table three times.
    """
    single, recurring = split_recurring(df, keys)
    return single.unionByName(first_per_key(recurring, keys, order or total_order(df, keys)))


def _file_hash(lineage: Sequence[Column], turn: int) -> Column:
    """A hash of the file; those of two turns are independent."""
    return F.xxhash64(F.lit(turn), *lineage)


def _newest_sieve(rows: DataFrame, keys: Sequence[str], lineage: Sequence[str], digest: str, turn: int) -> Sieve:
    """A sieve of the newest file of each key."""
    (newest,) = _unused(rows, "_newest")
    files = rows.groupBy(digest, *cols_of(keys)).agg(F.max(F.struct(*cols_of(lineage))).alias(newest))
    marked = _file_hash([F.col(newest)[c] for c in lineage], turn)
    return Sieve(pin(files.select(F.col(digest).alias("_digest"), marked.alias("_mark")), "newest"))


def dedup_newest(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`dedup` for wide tables with many copies.

    Keys and lineage alone tell the newest file of each key.  Rows of older files are dropped
    where they are read, by a sieve of (key, newest file).  Keys and lineage of the rows left
    are written; of a key that still has several, most were let through by chance, and a
    second sieve, of the newest files of such keys, drops those.  Only keys that then have
    more than one row are ordered as a whole: wide rows are built and moved for those alone.
    What is ordered is written, so that the driver plans with the bitmaps of one scan at a time.
    """
    keyed = {k.lower() for k in keys}
    lineage = [c for c in LINEAGE if has_column(df, c) and c not in keyed]
    if not lineage:
        return dedup_sieved(df, keys)
    key, file, again = F.xxhash64(*cols_of(keys)), *[_file_hash(cols_of(lineage), turn) for turn in (1, 2)]
    (digest,) = _unused(df, "_digest")
    rows = df.select(key.alias(digest), *cols_of([*keys, *lineage]))
    newest = _newest_sieve(rows, keys, lineage, digest, 1)
    left = pin(newest.divide(rows, F.col(digest), file)[1], "left")
    kept = newest.passes(key, file)
    repeated = _recurring(left.select(F.col(digest).alias("_digest")))
    if repeated.empty:
        return df.filter(kept)
    several = repeated.divide(left, F.col(digest))[1]
    second = _newest_sieve(several, keys, lineage, digest, 2)
    kept = kept & (~repeated.passes(key) | second.passes(key, again))
    tied = _recurring(second.divide(several, F.col(digest), again)[1].select(F.col(digest).alias("_digest")))
    ordered = first_per_key(df.filter(tied.passes(key) & kept), keys, total_order(df, keys))
    return df.filter(kept & ~tied.passes(key)).unionByName(pin(ordered, "ordered"))


def few(df: DataFrame) -> bool:
    return df.count() < FEW_ROWS


def dedup_large(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`dedup` by the way that moves least: the same rows, whatever the size.

    A count of the rows decides, and their width.
    """
    if few(df):
        return dedup(df, keys)
    others = len(df.columns) - len(keys) - len(LINEAGE)
    return dedup_newest(df, keys) if others > WIDE else dedup_sieved(df, keys)


def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct."""
    return df.dropDuplicates()


def dedup_rows_large(df: DataFrame, label: str) -> DataFrame:
    """:func:`dedup_rows` that moves only rows whose hash recurs; ``df`` is written with it."""
    columns = cols_of(df.columns)
    (digest,) = _unused(df, "_digest")
    hashed = pin(df.withColumn(digest, F.xxhash64(*columns)), label)
    single, recurring = split_recurring(hashed, df.columns, F.col(digest))
    return single.select(*columns).unionByName(dedup_rows(recurring.select(*columns)))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*cols_of(keys)).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def worst_duplicates(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The ``n`` most repeated keys; ties in key order."""
    order = [F.desc("row_count"), *[col_of(k).asc_nulls_last() for k in keys]]
    return duplicate_keys(df, keys).orderBy(*order).limit(n)


def duplicate_breakdown(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Number of duplicated keys per ``by``.  Keys with a NULL part are left out."""
    known = df.dropna(subset=list(keys))
    return duplicate_keys(known, keys).groupBy(*cols_of(by)).agg(F.count("*").alias("duplicate_keys"))


def dedup_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before and after de-duplication, removed rows and their percentage.

    Needs the keys only: one partial count per key, no row is moved.
    """
    per_key = df.groupBy(*cols_of(keys)).agg(F.count("*").alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("before_rows"), F.count("*").alias("after_rows")
    )
    removed = F.col("before_rows") - F.col("after_rows")
    share = F.when(F.col("before_rows") > 0, F.round(removed * 100.0 / F.col("before_rows"), 2))
    return totals.select(
        "before_rows",
        "after_rows",
        removed.alias("removed_rows"),
        share.cast("double").alias("removed_percent"),
    )
