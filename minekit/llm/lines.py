"""Line deduplication that returns bitmaps of lines to drop, not texts. DataFrame functions only.

The lines that can repeat are written once as (two hashes of the key, document, position). Keys that hold more
than a thousandth of them (at most a thousand keys, found in a bounded sample) are settled by aggregates that
combine before the shuffle and are then broadcast. All other lines are range-partitioned by hash and sorted by
document and position inside each range, so that one pass over a partition meets the kept document first.
The lines to drop become words of 64 bits per document; words without a bit are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ascii_lower, stored, text_hash

_SPACE = " \t\n\x0b\f\r"
#: A key with more than this share of the sampled lines is settled apart; so there are at most 1 / share.
HOT_SHARE, SAMPLED_LINES = 0.001, 2_000_000


def split_lines(text: Column) -> Column:
    """The lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(_SPACE)))


def repeatable_lines(docs: DataFrame, id: str, text: str, min_chars: int) -> DataFrame:
    """`doc`, `hash` of its text, `pos` of the line and `h1`, `h2` of the key, for keys of `min_chars` or more.

    Two documents rows with equal id and text give the same rows, which count once later on.
    """
    lines = docs.select(
        F.col(id).alias("doc"), text_hash(F.col(text)).alias("hash"), F.posexplode(split_lines(F.col(text))).alias("pos", "line")
    )
    keys = lines.select("doc", "hash", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keys.select("doc", "hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.concat(F.lit("#"), "key")).alias("h2"))


def _dropped(lines: DataFrame, min_docs: int) -> DataFrame:
    """`doc`, `hash`, `pos` of the lines to drop."""
    key = ["h1", "h2"]
    total = lines.count()
    share = min(1.0, SAMPLED_LINES / max(total, 1))
    sample = lines if share == 1.0 else lines.sample(share, seed=11)
    hot = sample.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") > max(HOT_SHARE * share * total, 100)).select(*key)
    # One row per key and document first, so that a key's documents are counted by many tasks.
    facts = stored(
        lines.join(F.broadcast(hot), key).groupBy(*key, "doc").agg(F.lit(1).alias("one"))
        .groupBy(*key).agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("keeper")), "hot-lines")
    known = lines.join(F.broadcast(facts), key).where((F.col("docs") >= min_docs) & ~F.col("doc").eqNullSafe(F.col("keeper")))

    rest = lines.join(F.broadcast(facts.select(*key)), key, "left_anti").repartitionByRange(*key)
    group = Window.partitionBy(*key)
    ordered = group.orderBy(F.desc_nulls_last("doc"), "hash", "pos")
    streamed = rest.select(
        "*", F.first("doc").over(ordered).alias("keeper"),
        (F.row_number().over(ordered).eqNullSafe(1) | ~F.lag("doc").over(ordered).eqNullSafe(F.col("doc"))).alias("new_doc"),
    ).withColumn("docs", F.count_if("new_doc").over(group))
    cold = streamed.where((F.col("docs") >= min_docs) & ~F.col("doc").eqNullSafe(F.col("keeper")))
    columns = ["doc", "hash", "pos"]
    return known.select(*columns).unionByName(cold.select(*columns))


def line_bitmaps(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """`doc`, `hash` (of the text) and `dropped`, an array of (`word`, `bits`): bit b of word w set means that
    line 64 w + b is to be dropped. Documents that keep all lines have no row.

    A key of at least `min_chars` code points in at least `min_docs` documents loses its lines in all but the
    largest id that holds it. Rows sharing an id (or without one, the smallest) count as one document.
    """
    gone = _dropped(stored(repeatable_lines(docs, id, text, min_chars), "lines"), min_docs)
    words = gone.groupBy("doc", "hash", F.floor(F.col("pos") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    return words.groupBy("doc", "hash").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped"))


def positions(dropped: Column) -> Column:
    """The line numbers a bitmap marks."""
    return F.flatten(F.transform(dropped, lambda w: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.getbit(w.bits, b) == 1), lambda b: w.word * 64 + b)))


def kept_text(text: Column, dropped: Column) -> Column:
    """The lines that a bitmap does not mark, joined again."""
    lines = split_lines(text)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), positions(dropped))
    # The lines are bound to a lambda variable, so they are split once and not once per line.
    joined = F.transform(F.array(F.struct(lines.alias("lines"), kept.alias("kept"))),
                         lambda s: F.array_join(F.transform(s.kept, lambda i: F.get(s.lines, i)), "\n"))
    return F.when(dropped.isNull(), F.coalesce(text, F.lit(""))).otherwise(joined[0])


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`row` (the columns of `docs` as a struct) and `dropped` (null where all lines stay)."""
    rows = docs.select(F.struct("*").alias("row"), F.col(id).alias("_id"), text_hash(F.col(text)).alias("_hash"))
    matched = rows["_id"].eqNullSafe(bitmaps["doc"]) & (rows["_hash"] == bitmaps["hash"])
    return rows.join(bitmaps, matched, "left").select("row", "dropped")


def line_dedup(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """Per row of `docs`: its id, `n_lines` before dropping, `n_dropped` and `kept_sha256` of the text that stays."""
    joined = with_bitmaps(docs, line_bitmaps(docs, id, text, min_chars, min_docs), id, text)
    body, dropped = F.col("row")[text], F.col("dropped")
    marked = F.aggregate(dropped, F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w.bits))
    return joined.select(
        F.col("row")[id].alias(id),
        F.size(split_lines(body)).cast("long").alias("n_lines"),
        F.coalesce(marked, F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(kept_text(body, dropped), 256).alias("kept_sha256"),
    )


def without_repeated_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """`docs` with the repeated lines taken out of `text`. All rows stay; texts without such lines (null
    included) stay as they are."""
    joined = with_bitmaps(docs, line_bitmaps(docs, id, text, min_chars, min_docs), id, text)
    row, dropped = F.col("row"), F.col("dropped")
    return joined.select(*[
        F.when(dropped.isNull(), row[c]).otherwise(kept_text(row[c], dropped)).alias(c) if c == text else row[c].alias(c)
        for c in docs.columns
    ])
