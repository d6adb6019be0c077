"""What the corpus operators share: table access, bounded training samples, checkpoints, text units."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import importable, shared_folder

#: Rows and bytes of one Arrow batch handed to Python, so that a worker's memory doesn't depend on the length of texts.
BATCH_ROWS, BATCH_BYTES = 1000, 2 << 20

#: A-Z to a-z and nothing else, for str.translate and translate().
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch bounds to BATCH_ROWS and BATCH_BYTES; smaller ones that are set stay."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = str(spark.conf.get(key, str(most))).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def replacing(docs: DataFrame, text: str, *made: str) -> DataFrame:
    """docs without the columns whose names the operator gives its own; the text itself can't be one of them."""
    if text in made:
        raise ValueError(f"the text column has the name of a result: {text}")
    return docs.drop(*(n for n in made if n in docs.columns))


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """mapInArrow with batches of bounded size."""
    bounded_batches(df.sparkSession)
    importable(df.sparkSession)
    return df.mapInArrow(function, schema)


def ascii_lower(text: str) -> str:
    """A-Z lower-cased, all other characters as they are."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def ascii_lower_column(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: what the session names in spark.checkpoint.dir.

    Where that is unset, a local session gets a folder of its own; on a cluster it must be set, as a folder of one machine
    would be lost with it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame's rows in the shared checkpoint folder, with its lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The frame's rows as a Parquet table in the shared checkpoint folder: smaller than a checkpoint, and read by columns."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def not_broadcast(df: DataFrame) -> DataFrame:
    """The frame as a side of a join by shuffles. Spark takes a table by the size of its compressed files and doesn't count the
    rows that explode() adds, so what grows with the input may pass for small and would be built in the driver's memory."""
    return df.hint("merge")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; rows at 1 are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 1, F.lit(False))


def training_sample(labelled: DataFrame, label: str, texts: DataFrame, text: str, key: str, per_label: int, label_chars: int, seed: int) -> dict[object, list[str]]:
    """A bounded sample of whole texts by label.

    labelled has keys and labels, texts keys and texts (it may be the same table). Keys are drawn by a hash below a threshold
    which the counts of all labelled rows give, so about 2 * per_label keys of each label come to the driver, however many
    there are; the two tables aren't joined, the texts of the drawn keys alone are looked up. In the order of the keys'
    hashes, texts are taken while a label has no more than per_label of them and label_chars characters. A longer text is
    passed over; if every text of a label is longer, its shortest one gives its middle label_chars characters. Every label is
    learned, so what is held grows with the number of labels, not of rows. A null text is an empty one; of texts with equal
    keys the first in order counts.
    """
    labelled = labelled.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    counts = {r[0]: r[1] for r in labelled.groupBy(label).count().collect()}
    if not counts:
        return {}
    unit = F.xxhash64(F.col(key), F.lit(seed)).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)
    kind = next(f.dataType for f in labelled.schema if f.name == label)
    shares = labelled.sparkSession.createDataFrame([(v, min(1.0, (2 * per_label + 20) / n)) for v, n in counts.items()], T.StructType([T.StructField("v", kind), T.StructField("share", T.DoubleType())]))
    marked = labelled.select(F.col(key).alias("k"), F.col(label).alias("v"), unit.alias("unit")).join(F.broadcast(shares), "v")
    drawn = marked.where("unit < share").select("k", "v", "unit").distinct().collect()
    order = sorted(drawn, key=lambda r: (r["unit"], str(r["k"]), str(r["v"])))
    rows = texts.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    found = rows.where(F.col("k").isin([r["k"] for r in order])).groupBy("k").agg(F.min(F.struct(F.length("t").alias("n"), F.xxhash64("t").alias("h"))).alias("x"))
    sizes = {r["k"]: r["x"]["n"] for r in found.collect()}
    chosen: dict[object, dict] = {value: {} for value in counts}
    used = dict.fromkeys(counts, 0)
    for r in order:
        n, value = sizes.get(r["k"]), r["v"]
        if n is not None and len(chosen[value]) < per_label and used[value] + n <= label_chars:
            chosen[value][r["k"]] = 0
            used[value] += n
    for value, keys in chosen.items():
        if not keys and (longer := [(sizes[r["k"]], r["unit"], r["k"]) for r in order if r["v"] == value and r["k"] in sizes]):
            n, _, k = min(longer, key=lambda x: x[:2])
            keys[k] = max(0, (n - label_chars) // 2)
    start = F.lit(1)
    for keys in chosen.values():
        for k, at in keys.items():
            if at:
                start = F.when(F.col("k") == F.lit(k), F.lit(at + 1)).otherwise(start)
    wanted = [k for keys in chosen.values() for k in keys]
    cut = F.struct(F.length("t").alias("n"), F.xxhash64("t").alias("h"), F.substring(F.col("t"), start, F.lit(label_chars)).alias("t"))
    taken = {r["k"]: r["x"]["t"] for r in rows.where(F.col("k").isin(wanted)).groupBy("k").agg(F.min(cut).alias("x")).collect()} if wanted else {}
    return {value: [taken[k] for k in keys if k in taken] for value, keys in chosen.items() if keys}


#: Of all rows, a key that has more than one in so many is a heavy one; there are fewer such keys than this.
HEAVY = 10_000


def join_on_counted(rows: DataFrame, keys: DataFrame, on: list[str], n: str = "n") -> DataFrame:
    """rows joined with keys (one row each, n: how many of the rows have it), without a hot key in one task.

    Fewer than HEAVY keys can have more than a HEAVY-th of all rows each; those are broadcast, a bound that holds at any size.
    The others are joined by shuffles in which no key has more than that. rows is read twice: a written table is best.
    """
    total = keys.agg(F.sum(n)).first()[0] or 0
    heavy = F.col(n) > total / HEAVY
    often, columns = keys.where(heavy), [c for c in keys.columns if c not in on]
    met = rows.join(F.broadcast(often), on)
    rest = rows.join(F.broadcast(often.select(*on)), on, "left_anti").join(not_broadcast(keys.where(~heavy)), on)
    return met.select(*rows.columns, *columns).unionByName(rest.select(*rows.columns, *columns))
