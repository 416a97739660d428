"""Benchmark decontamination with a broadcast hash set of normalised word windows. SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
#: Windows in one broadcast set. A larger benchmark is cut into sets by hash, each broadcast in its own pass.
SET_WINDOWS = 200_000

# Fixed value: what counts as a word, given lower-cased A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before A-Z is lower-cased.
ANY_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Lower-cased words; none for null."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def _window_hashes(column: str, size: int) -> Column:
    """Hash of the first, middle and last words of each window; equal windows have equal hashes."""
    picks = ", ".join(f"{column}[i + {k}]" for k in sorted({0, size // 2, size - 1}))
    return F.expr(
        f"CASE WHEN size({column}) >= {size} THEN transform(sequence(0, size({column}) - {size}),"
        f" i -> xxhash64({size}, {picks})) ELSE cast(array() AS array<bigint>) END"
    )


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """h, size, gram (the words), items: the different windows of all items. An item of fewer words is one window."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0")
    grams = items.select(
        "item_id",
        F.explode(
            F.expr(
                f"CASE WHEN size(w) < {window} THEN array(w)"
                f" ELSE transform(sequence(1, size(w) - {window} + 1), i -> slice(w, i, {window})) END"
            )
        ).alias("gram"),
    )
    sets = grams.groupBy("gram").agg(F.collect_set("item_id").alias("items")).withColumn("size", F.size("gram"))
    # The array functions count from 0 in brackets; the three words are those of _window_hashes.
    h = F.expr("xxhash64(size, gram[0], gram[size div 2], gram[size - 1])")
    one = F.expr("CASE WHEN size = 1 THEN xxhash64(size, gram[0]) WHEN size = 2 THEN xxhash64(size, gram[0], gram[1]) END")
    return sets.select(F.coalesce(one, h).alias("h"), "size", "gram", "items")


def hits(rows: DataFrame, benchmark: DataFrame, window: int = WINDOW, set_windows: int = SET_WINDOWS) -> DataFrame:
    """_row, n_words, at, size, items: where a benchmark window occurs in `rows` (_row, text); one row without `at` each.

    Document windows are hashed and looked up in the broadcast set; what is found is compared word by word. One set has
    `set_windows` windows at most: a larger benchmark takes several passes, each over the windows of a hash range.
    """
    grams = benchmark_windows(benchmark, window)
    known = grams.agg(F.count("*").alias("n"), F.collect_set("size").alias("sizes")).first()
    sizes, passes = sorted(known.sizes), -(-known.n // set_windows)
    tokens = rows.select("_row", words(F.col("text")).alias("w"))
    tokens = tokens.select("_row", "w", F.size("w").alias("n_words"))
    hashes = [_window_hashes("w", size) for size in sizes]
    # The first entry stands for the document itself, so that documents without a hit stay.
    scanned = tokens.select(
        "_row", "w", "n_words", F.posexplode(F.concat(F.array(F.lit(None).cast("bigint")), *hashes)).alias("place", "h")
    )
    at = F.lit(None).cast("int")
    begin = F.lit(1)
    for size in sizes:  # where the hashes of each window size begin
        at = F.when((F.col("size") == size) & (F.col("place") >= begin), F.col("place") - begin).otherwise(at)
        begin = begin + F.greatest(F.col("n_words") - size + 1, F.lit(0))
    # Not written as an equality, which would become a join key worked out for every window.
    same = F.array_contains(F.array(F.slice("w", at + 1, F.col("size"))), F.col("gram"))
    out = None
    for part in range(max(1, passes)):
        chosen = grams.where(F.pmod(F.xxhash64("gram"), F.lit(passes)) == part) if passes > 1 else grams
        named = F.broadcast(chosen.select(F.col("h").alias("_h"), "size", "gram", "items"))
        met = scanned.join(named, F.col("h") == F.col("_h"), "left" if part == 0 else "inner")
        met = met.where((F.col("place") == 0) & F.lit(part == 0) | F.col("gram").isNotNull() & same)
        met = met.select("_row", "n_words", at.alias("at"), "size", "items")
        out = met if out is None else out.union(met)
    return out


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, set_windows: int = SET_WINDOWS) -> DataFrame:
    """Per row of `docs`: doc_id, _row, n_words, n_hit, spans (array of [from, to) word ranges), items (found, sorted as text).

    A word inside any occurrence of a benchmark window is hit. Null and empty texts have no words; items without words
    have no windows. Rows that repeat a doc_id are judged one by one, copies of a benchmark item share its windows. An
    empty benchmark hits nothing. Columns other than doc_id and text are ignored.
    """
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_n")).select(
        "text", F.struct("doc_id", "_n").alias("_row")
    )
    both = F.struct("at", (F.col("at") + F.col("size")).alias("to"))
    found = (
        hits(rows, benchmark, window, set_windows)
        .groupBy("_row")
        .agg(
            F.max("n_words").alias("n_words"),
            F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), both))).alias("found"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
    )
    merged = F.expr(
        "aggregate(found, cast(array() AS array<struct<at:int,to:int>>), (a, x) ->"
        " CASE WHEN size(a) > 0 AND x.at <= a[size(a) - 1].to THEN"
        " CASE WHEN x.to <= a[size(a) - 1].to THEN a"
        " ELSE concat(slice(a, 1, size(a) - 1), array(struct(a[size(a) - 1].at AS at, x.to AS to))) END"
        " ELSE concat(a, array(struct(x.at AS at, x.to AS to))) END)"
    )
    named = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "_row.doc_id",
        F.col("_row._n").alias("_row"),
        F.col("n_words").cast("bigint").alias("n_words"),
        merged.alias("spans"),
        named.alias("items"),
    ).withColumn("n_hit", F.expr("aggregate(spans, 0L, (n, s) -> n + s.to - s.at)"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` whose text holds no benchmark window; columns are kept.

    Rows that repeat a doc_id, or have none, are told apart by a hash of their text: clean ones stay.
    """
    marked = docs.select(F.struct("doc_id", F.md5("text").alias("mark")).alias("doc_id"), "text")
    found = report(marked, benchmark, **options).where("n_hit > 0")
    bad = found.select(F.col("doc_id.doc_id").alias("_contaminated"), F.col("doc_id.mark").alias("_mark")).distinct()
    at, text = (F.col(f"c{docs.columns.index(name)}") for name in ("doc_id", "text"))
    own = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    same = at.eqNullSafe(F.col("_contaminated")) & (F.md5(text) == F.col("_mark"))
    return own.join(bad, same, "left_anti").toDF(*docs.columns)


def without_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`docs` with hit words cut out, each with what follows it up to the next word; columns are kept.

    Rows that repeat a doc_id, or have none, are told apart by a hash of their text, so each is cut by its own hits.
    """
    marked = docs.select(F.struct("doc_id", F.md5("text").alias("mark")).alias("doc_id"), "text")
    found = report(marked, benchmark, **options).where("n_hit > 0")
    # Rows alike in id and text have the same hits.
    spans = found.select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id.mark").alias("_mark"), "spans")
    spans = spans.dropDuplicates(["_id", "_mark"])
    own = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at, text = (f"c{docs.columns.index(name)}" for name in ("doc_id", "text"))
    piece = f"{ANY_WORD}[^{ANY_WORD[1:-2]}]*"
    lead = F.regexp_extract(text, f"^[^{ANY_WORD[1:-2]}]*", 0)
    body = F.expr(f"substring({text}, length(_lead) + 1)")
    cut = F.expr(
        "concat(_lead, array_join(filter(_pieces, (p, i) -> NOT exists(spans, s -> i >= s.at AND i < s.to)), ''))"
    )
    same = F.col(at).eqNullSafe(F.col("_id")) & (F.md5(text) == F.col("_mark"))
    rows = own.join(spans, same, "left").withColumn("_lead", lead)
    rows = rows.withColumn("_pieces", F.regexp_extract_all(body, F.lit(piece), F.lit(0)))
    left = F.when(F.col("spans").isNull(), F.col(text)).otherwise(cut)
    return rows.withColumn(text, left).select(*own.columns).toDF(*docs.columns)
