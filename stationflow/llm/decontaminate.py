"""Benchmark decontamination by size-partitioned MinHash containment search,
verified by exact shingle containment. DataFrame functions only.

Items are partitioned by the number of their shingles into classes of doubling
size. For a class whose items have at most u shingles, every item keeps a
bottom-k MinHash sketch with k = (most shingles a match may lack) + 1, tuned to
u, the class's upper bound: a document that contains the wanted share of an item
lacks at most k-1 of its shingles, so it holds at least one of the k sketched
ones however long the document is. The search therefore loses nothing; it only
over-finds. Candidates are then counted exactly, shingle by shingle.

Long documents cost what their length costs: shingles are exploded row by row
and probed against the sketches, never compared with one another.

Shingles are five consecutive words, A-Z lower-cased; an item of one to four
words is one shingle, looked for among the documents' runs of as many words; a
null or empty text has none and matches nothing. Repeated items and repeated
documents match alike; null ids are kept. Other columns are ignored.

Items go by a number from the first step on, and what is broadcast is measured in
bytes before; beyond the bound Spark joins by shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.shared import stored

SHINGLE_WORDS = 5
#: A document contains an item if it holds this many hundredths of its shingles.
PERCENT = 80
#: Bytes of sketches, or of spelled shingles, up to which they are broadcast;
#: and what a row takes beside its characters.
MOST_BROADCAST_BYTES, _ROW_BYTES = 32 << 20, 32
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_words(rows: DataFrame, text: str = "text") -> DataFrame:
    lowered = F.translate(F.regexp_replace(text, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""), _UPPER, _LOWER)
    none = F.array().cast("array<string>")
    return rows.withColumn("_t", lowered).withColumn("_w", F.when(F.coalesce(F.col("_t"), F.lit("")) == "", none).otherwise(F.split("_t", r"[\x20\x09-\x0D]+"))).drop("_t")


def _runs(made: str, n: int) -> str:
    """Array of ``made`` (an expression over ``s``) for each run of n words."""
    return f"CASE WHEN size(_w) >= {n} THEN transform(sequence(1, size(_w) - {n - 1}), i -> {made.format(s=f'slice(_w, i, {n})')}) ELSE array() END"


def _each_run(made: str, lengths: list[int]) -> str:
    return f"concat({', '.join(_runs(made, n) for n in lengths)})"


HASHED, SPELLED = "xxhash64({s})", "concat_ws(' ', {s})"


def numbered_items(benchmark: DataFrame) -> DataFrame:
    """``item, item_id, text``: rows of equal id and text are one item, with a
    number (stored, so that it stays)."""
    items = benchmark.select("item_id", "text").dropDuplicates()
    return stored(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"), "benchmark-items")


def item_shingles(items: DataFrame) -> DataFrame:
    """``item, shingle, h, n_item, words``: each item's distinct shingles, of
    ``words`` words."""
    short = f"CASE WHEN size(_w) BETWEEN 1 AND {SHINGLE_WORDS - 1} THEN array(concat_ws(' ', _w)) ELSE {_runs(SPELLED, SHINGLE_WORDS)} END"
    # Exploded where it is made: a filter on a column of arrays would make them twice.
    each = with_words(items).select("item", F.explode(F.array_distinct(F.expr(short))).alias("shingle"))
    words, h = F.size(F.split("shingle", " ")), F.expr("xxhash64(split(shingle, ' '))")
    return each.select("item", "shingle", h.alias("h"), words.alias("words")).withColumn("n_item", F.expr("count(*) over (partition by item)"))


def sketches(shingles: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``item, h``: bottom-k MinHash sketch of each item, k from the upper bound
    of its size class."""
    upper = F.expr("cast(pow(2, ceil(log2(n_item))) as int)")
    k = F.floor(upper * (100 - percent) / 100) + 1
    rank = F.expr("row_number() over (partition by item order by h)")
    return shingles.withColumns({"k": k, "r": rank}).where("r <= k").select("item", "h")


def _sent(rows: DataFrame, most: int) -> DataFrame:
    """Rows (stored before) marked for broadcast if their bytes are few enough."""
    names = [F.octet_length(c) for c, kind in rows.dtypes if kind == "string"]
    size = rows.agg(F.sum(sum(names, F.lit(_ROW_BYTES)))).first()[0] or 0
    return F.broadcast(rows) if size <= most else rows


def find_benchmark(
    documents: DataFrame, benchmark: DataFrame, *, percent: int = PERCENT, most_broadcast: int = MOST_BROADCAST_BYTES
) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment`` for every pair of a
    document and an item of which it holds at least ``percent`` hundredths."""
    items = numbered_items(benchmark)
    shingles = stored(item_shingles(items), "benchmark-shingles")
    # The lengths of shingles: five and those of shorter items, five at most.
    lengths = sorted(r["words"] for r in shingles.select("words").distinct().collect()) or [SHINGLE_WORDS]
    own = stored(sketches(shingles, percent), "benchmark-sketches")
    probes = _sent(stored(own.select("h").distinct(), "benchmark-probes"), most_broadcast)
    docs = with_words(documents.select("doc_id", "text"), "text")
    hashed = docs.select("doc_id", F.explode(F.expr(_each_run(HASHED, lengths))).alias("h"))
    hits = hashed.join(probes, "h").distinct()
    pairs = hits.join(_sent(own, most_broadcast), "h").select("doc_id", "item").distinct()
    # Exact step: only candidate documents, all their shingles, spelled out.
    few = pairs.select("doc_id").distinct()
    texts = documents.select("doc_id", "text").join(few, documents["doc_id"].eqNullSafe(few["doc_id"]), "left_semi").dropDuplicates()
    spelled = with_words(texts, "text").select("doc_id", F.explode(F.array_distinct(F.expr(_each_run(SPELLED, lengths)))).alias("shingle"))
    held = spelled.join(_sent(shingles.select("item", "shingle", "n_item"), most_broadcast), "shingle")
    counted = held.groupBy("doc_id", "item", "n_item").agg(F.countDistinct("shingle").alias("n_shared"))
    searched = counted.join(pairs.withColumnsRenamed({"doc_id": "_d", "item": "_i"}), F.expr("doc_id <=> _d and item = _i"), "left_semi")
    enough = searched.where(F.col("n_shared") * 100 >= F.col("n_item") * percent)
    return enough.join(items.select("item", "item_id"), "item").select(
        "doc_id", "item_id", F.col("n_item").cast("long").alias("n_item"), F.col("n_shared").cast("long").alias("n_shared"),
        (F.col("n_shared") / F.col("n_item")).alias("containment"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, *, percent: int = PERCENT) -> DataFrame:
    """Documents that contain no benchmark item, unchanged."""
    found = find_benchmark(documents, benchmark, percent=percent).select(F.col("doc_id").alias("_d")).distinct()
    return documents.join(found, documents["doc_id"].eqNullSafe(found["_d"]), "left_anti")
