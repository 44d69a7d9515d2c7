"""Writers of records, bundles, splits, points, vocabularies and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rows of a report that is written as one JSON document, at most.
SMALL_ROWS = 10_000


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> float:
    """Lines of JSON; returns their size in MB, computed from what is written."""
    df.write.mode(mode).json(path)
    size = df.sparkSession.read.text(path).agg(F.sum(F.octet_length("value") + 1)).first()[0] or 0
    return size / (1024 * 1024)


def write_document(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON array in one file; for small reports only."""
    rows = df.limit(SMALL_ROWS + 1)
    if rows.count() > SMALL_ROWS:
        raise ValueError(f"a document holds at most {SMALL_ROWS} rows; write lines of JSON instead")
    rows.agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value")).coalesce(1).write.mode(mode).text(path)


def write_bundle(df: DataFrame, path: str, tokens: str = "tokens", mode: str = "overwrite") -> None:
    """Sequences as Parquet by source, the scalable form of a bundle."""
    parts = ["source"] if "source" in df.columns else []
    df.withColumn("n_tokens", F.size(tokens)).write.mode(mode).partitionBy(*parts).parquet(path)


def write_splits(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy("split").parquet(path)


def write_points(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.select("id", "vector", "payload").write.mode(mode).json(path)


def write_vocabulary(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.select("token", "id", "freq").write.mode(mode).parquet(path)


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Statistics or a manifest as lines of JSON in one file."""
    df.coalesce(1).write.mode(mode).json(path)


def append_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_tree(df: DataFrame, path: str) -> None:
    """Files (path, content) below a folder that all executors share, each row a file of its own."""

    def run(rows) -> None:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)
        made = set()
        for r in rows:
            folder = f"{root}/{r['path']}".rsplit("/", 1)[0]
            if folder not in made:
                system.create_dir(folder)
                made.add(folder)
            with system.open_output_stream(f"{root}/{r['path']}") as f:
                f.write(bytes(r["content"]))

    df.select("path", "content").foreachPartition(run)


def write_if_missing(df: DataFrame, path: str) -> None:
    """Skips a stage whose output exists."""
    df.write.mode("ignore").parquet(path)
