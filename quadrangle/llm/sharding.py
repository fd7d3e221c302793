"""Shards of bounded bytes by extendible hashing.

A row's hash is a string of bits; a bucket is a prefix of it. The directory starts as one
bucket, and only buckets over the byte limit split on one more bit. Bytes are summed once
per prefix of `STEP` bits, and all the splits within those bits are read off that table;
only rows of prefixes that are still too large are summed again, `STEP` bits deeper.

Equal rows have equal bits, so a bucket that holds copies of one row alone cannot be
split by hashing: its rows go to overflow pages, numbered per task and filled up to the
limit. A single row over the limit is a shard of its own. Built-in functions only.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from quadrangle.session import cut

BITS = 60
STEP = 12
LIMIT_BYTES = 256 * 1024 * 1024


def row_hash(*columns):
    """60 bits of an MD5 over the columns, as a long; null differs from an empty string."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, BITS // 4), 16, 10).cast("long")


def _prefix(hashed, depth):
    """The first `depth` bits of a hash."""
    return F.shiftright(hashed, BITS - depth)


def _buckets(sums, low, high, limit):
    """Buckets of depth `low` to `high` whose parents are too large, from sums per prefix
    of `high` bits. Every parent of depth `low` - 1 is known to be too large."""
    cells = sums.select("leaf", "bytes", "rows", "least", "most", "widest", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"))
    nodes = (
        cells.groupBy("depth", F.call_function("shiftright", F.col("leaf"), F.lit(high) - F.col("depth")).alias("bucket"))
        .agg(
            F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.min("least").alias("least"),
            F.max("most").alias("most"), F.max("widest").alias("widest"),
        )
        .withColumn("settled", (F.col("bytes") <= limit) | (F.col("least") == F.col("most")))
    )
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("bucket").alias("up"), F.col("settled").alias("enough"))
    return (
        nodes.withColumn("up", F.shiftright("bucket", 1))
        .join(parents, ["depth", "up"], "left")
        .where((F.col("depth") == low) | ~F.col("enough"))
        .drop("up", "enough")
    )


def directory(hashed, limit):
    """(depth, prefix, shard_bytes, shard_rows, widest) of every shard, from (h, bytes)."""
    found, rest, low, high = None, hashed, 0, STEP
    while True:
        sums = rest.groupBy(_prefix(F.col("h"), high).alias("leaf")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("rows"), F.min("h").alias("least"),
            F.max("h").alias("most"), F.max("bytes").alias("widest"),
        )
        nodes = cut(_buckets(sums, low, high, limit))
        done = nodes.where("settled").select(
            F.col("depth").alias("depth"), F.col("bucket").alias("prefix"), F.col("bytes").alias("shard_bytes"),
            F.col("rows").alias("shard_rows"), "widest",
        )
        found = done if found is None else found.unionByName(done)
        large = nodes.where(~F.col("settled") & (F.col("depth") == high)).select(F.col("bucket").alias("large"))
        if high == BITS or large.isEmpty():
            return cut(found)
        rest = rest.join(large, _prefix(F.col("h"), high) == F.col("large"), "left_semi")
        low, high = high + 1, high + STEP


def assign_shards(table, keys, limit=LIMIT_BYTES):
    """Every row of `table` as struct `row`, and the shard it belongs to.

    With it come `n_bytes` (UTF-8 bytes of the row's columns as text; null counts
    nothing), `depth` and `prefix` (the shard's bits), `shard_bytes`, `shard_rows` and
    `page`. A shard holds at most `limit` bytes, unless it is one row, or rows equal in
    all `keys`: the latter lie on pages 1 and up, each at most `limit` bytes (one row
    where a row is larger); all other rows are on page 0. Rows are told apart by `keys`,
    where null is a value of its own. An empty table has no shards.
    """
    named = [F.col(f"`{c}`") for c in table.columns]
    n_bytes = F.lit(0).cast("long")
    for column in named:
        n_bytes = n_bytes + F.coalesce(F.octet_length(column.cast("string")), F.lit(0))
    rows = table.select(F.struct(*named).alias("row"), row_hash(*[f"`{c}`" for c in keys]).alias("h"), n_bytes.alias("n_bytes"))
    found = directory(cut(rows.select("h", F.col("n_bytes").alias("bytes"))), limit)
    first = found.agg(F.min("depth")).first()[0] or 0
    # the bits of the shallowest shard pair a row with few deeper shards, one of them its own
    near = found.withColumn("near", F.call_function("shiftright", F.col("prefix"), F.col("depth") - first))
    own = F.call_function("shiftright", F.col("h"), F.lit(BITS) - F.col("depth")) == F.col("prefix")
    placed = rows.withColumn("at", _prefix(F.col("h"), first)).join(near, (F.col("at") == F.col("near")) & own)
    over = (F.col("shard_bytes") > limit) & (F.col("shard_rows") > 1)
    columns = ["row", "n_bytes", "depth", "prefix", "page", "shard_bytes", "shard_rows"]
    out = placed.withColumn("page", F.lit(0).cast("long"))
    if found.where(over).isEmpty():
        return out.select(*columns)
    # rows that no bit can part: pages are counted within a task, so none gathers a bucket
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("widest")))
    task = placed.where(over).withColumn("task", F.spark_partition_id().cast("long"))
    nth = F.row_number().over(Window.partitionBy("h", "task").orderBy("n_bytes"))
    pages = task.withColumn("page", F.col("task") * (1 << 32) + F.floor((nth - 1) / each) + 1)
    return out.where(~over).select(*columns).unionByName(pages.select(*columns))


def write_shards(table, keys, path, limit=LIMIT_BYTES):
    """Write `table` as Parquet, one folder per shard page; returns the number of pages.

    Rows are dealt out by shard, so a shard is written by one task and bounded by it."""
    placed = assign_shards(table, keys, limit)
    name = F.concat_ws("-", F.lpad(F.conv("prefix", 10, 2), F.greatest(F.col("depth"), F.lit(1)), "0"), F.col("page").cast("string"))
    named = placed.select("row.*", name.alias("shard"))
    named.repartition("shard").write.partitionBy("shard").parquet(path)
    return placed.select("depth", "prefix", "page").distinct().count()


DOCUMENT_SHARD_BYTES = 1024 * 1024


def document_shards(docs, limit=DOCUMENT_SHARD_BYTES):
    """(doc_id, n_bytes, depth, prefix, page, shard_bytes, shard_rows) for every row."""
    placed = assign_shards(docs.select("doc_id", "text"), ["doc_id", "text"], limit)
    return placed.select("row.doc_id", "n_bytes", "depth", "prefix", "page", "shard_bytes", "shard_rows")


SHARDS_SQL = f"""
WITH hashed AS (
  SELECT doc_id, coalesce(strlen(doc_id::VARCHAR), 0) + coalesce(strlen(text), 0) AS n_bytes,
         ('0x' || substr(md5(coalesce('=' || doc_id::VARCHAR, '-') || '|' || coalesce('=' || text, '-')), 1, 15))::BIGINT AS h
  FROM documents
), nodes AS (
  SELECT depth, h >> (60 - depth)::INTEGER AS prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows,
         sum(n_bytes) <= {DOCUMENT_SHARD_BYTES} OR min(h) = max(h) AS settled
  FROM hashed, range(0, 31) t(depth) GROUP BY ALL
), placed AS (
  SELECT doc_id, n_bytes, nodes.depth, prefix, shard_bytes, shard_rows,
         row_number() OVER (PARTITION BY hashed.rowid ORDER BY nodes.depth) AS nth
  FROM (SELECT *, row_number() OVER () AS rowid FROM hashed) hashed
  JOIN nodes ON settled AND prefix = h >> (60 - nodes.depth)::INTEGER
)
SELECT doc_id, n_bytes::BIGINT AS n_bytes, depth::INTEGER AS depth, prefix, 0::BIGINT AS page, shard_bytes, shard_rows
FROM placed WHERE nth = 1
"""
