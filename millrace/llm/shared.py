"""The folder that driver and executors share, tables cut there, and broadcasts of checked size."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids that a broadcast side may hold at most (about 16 bytes each in the executors); beyond it the join shuffles.
BROADCAST_IDS = 1_000_000
#: A key with more rows than this is hot: its rows are joined where they are, or dealt by SALTS salts.
HOT, SALTS = 256, 64
#: Facts of at most so many rows may be broadcast whole (a sketch of 16 words a row makes about 20 MB).
SMALL = 100_000


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once a session, unless their Python finds it as the driver's does."""
    root = Path(__file__).resolve().parents[2]
    paths = [Path(p or ".").resolve() for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]]
    if root in paths or getattr(spark.sparkContext, "_millrace_sent", False):
        return
    file = Path(tempfile.mkdtemp(prefix="millrace-code-")) / "millrace.zip"
    with zipfile.ZipFile(file, "w") as z:
        for p in sorted((root / "millrace").rglob("*.py")):
            z.write(p, p.relative_to(root))
        if (root / "corpus_pipeline.py").exists():
            z.write(root / "corpus_pipeline.py", "corpus_pipeline.py")
    spark.sparkContext.addPyFile(str(file))
    spark.sparkContext._millrace_sent = True


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder for ``name`` below spark.checkpoint.dir, which every executor can reach.

    Where that is unset and the master is local, as in tests, a temporary folder becomes the setting; a cluster must set it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = getattr(spark, "_millrace_dir", None)
        if base is None:
            base = spark._millrace_dir = "file://" + tempfile.mkdtemp(prefix="millrace-")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    spark._millrace_made = [*getattr(spark, "_millrace_made", []), path]
    return path


def cut(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends there and nothing is computed twice.

    ``codec`` is the files' compression, if not the session's.
    """
    spark = df.sparkSession
    ship(spark)
    path = shared_dir(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def light(df: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """``df`` marked for a broadcast if it has at most ``limit`` rows (they are counted), else as it is, for a shuffle.

    For tables of a few short columns that are in shared storage already, so that counting is cheap.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def attach(rows: DataFrame, facts: DataFrame, keys: list[str], spread: str, n: str = "n", limit: int = BROADCAST_IDS, whole: int = 0) -> DataFrame:
    """``rows`` left-joined with ``facts`` (in shared storage, one row a key) without a hot key's rows meeting in a task.

    ``n``, a column of the facts, tells about how many rows a key has. The facts of hot keys are broadcast where they
    are at most ``limit`` (there can be one for each HOT rows at most); beyond that they are repeated for each of SALTS
    salts, of which a row's is told by a hash of its column ``spread``. All others meet by a shuffle. Null keys match
    nothing: give rows with null keys a branch of their own if there may be many. Where all facts, with narrow rows, are
    at most ``whole``, they are broadcast and no row is shuffled.
    """
    columns = [*rows.columns, *[c for c in facts.columns if c not in keys]]
    if whole and facts.limit(whole + 1).count() <= whole:
        return rows.join(F.broadcast(facts), keys, "left").select(*columns)
    hot, cold = facts.where(F.col(n) > HOT), facts.where(F.col(n) <= HOT)
    many = hot.limit(limit + 1).count()
    if not many:
        return rows.join(cold, keys, "left").select(*columns)
    few, by, dealt = F.broadcast(hot), keys, rows
    if many > limit:
        by, dealt = [*keys, "_salt"], rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
        few = hot.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rest = dealt.join(few.select(*by), by, "left_anti").join(cold, keys, "left")
    return dealt.join(few, by).select(*columns).union(rest.select(*columns))


def forget(spark: SparkSession) -> int:
    """Deletes the folders that this session's operators made below spark.checkpoint.dir; returns how many.

    Tables that were returned read from them: call it when their results have been written.
    """
    made, conf = getattr(spark, "_millrace_made", []), spark._jsc.hadoopConfiguration()
    for folder in made:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    spark._millrace_made = []
    return len(made)
