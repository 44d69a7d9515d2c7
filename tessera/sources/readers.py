"""Readers of histories, sequences, trees and logs, and their schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEQUENCE_META = "struct<start_commit_idx:int,end_commit_idx:int,num_commits:int,total_tokens:int,sample_commit:string,author_name:string,commit_timestamp:bigint,primary_directory:string,final_sequence:boolean,source:string,file_path:string,branch:string,start_line:int,end_line:int>"
COMMIT = (
    "hash string, abbrev_hash string, parents array<string>, tree_hash string, author_name string, author_email string, author_timestamp bigint, committer_name string, committer_email string, commit_timestamp bigint, "
    "subject string, body string, is_merge boolean, branches array<string>, tags array<string>, files_added array<string>, files_modified array<string>, files_deleted array<string>, insertions bigint, deletions bigint, "
    "files_changed bigint, related_issues array<string>, complexity_score double, is_high_risk boolean"
)
NESTED_COMMITS = (
    "commits array<struct<meta:struct<hash:string,abbrev_hash:string,author:string,author_email:string,timestamp:string,timestamp_unix:bigint,message:string,message_body:string,parents:array<string>,is_merge:boolean,files_changed:bigint,insertions:bigint,deletions:bigint>,"
    "branches:array<struct<branch_name:string,is_current:boolean,is_remote:boolean,upstream:string>>,diffs:array<struct<filename:string,change_type:string,old_file:string,new_file:string,additions:bigint,deletions:bigint,patch:string,is_binary:boolean>>,tags:array<string>,commit_number:bigint>>"
)
METRICS = "step bigint, timestamp double, train_loss double, val_loss double, learning_rate double, grad_norm double"


def read_jsonl(spark: SparkSession, path: str, schema: str, limit: int | None = None) -> DataFrame:
    """Lines of JSON with a fixed schema; blank lines are skipped and bad ones kept in corrupt_record."""
    df = spark.read.schema(f"{schema}, corrupt_record string").option("columnNameOfCorruptRecord", "corrupt_record").json(path)
    return df.limit(limit) if limit is not None else df


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, COMMIT).where("hash is not null").drop("corrupt_record")


def read_nested_commits(spark: SparkSession, path: str, one_document: bool = True) -> DataFrame:
    """A JSON document with a list of commits per file, or per line, one row for each commit."""
    return spark.read.schema(NESTED_COMMITS).option("multiLine", one_document).json(path).select(F.inline("commits"))


def diffs_of(nested: DataFrame) -> DataFrame:
    return nested.select(F.col("meta.hash").alias("commit_hash"), F.posexplode("diffs").alias("pos", "d")).select("commit_hash", "pos", "d.*")


def read_bundle(spark: SparkSession, path: str, one_document: bool = True) -> DataFrame:
    """(pos, tokens, metadata): sequences of a JSON bundle per file, or per line, with their metadata, looked up by position."""
    doc = spark.read.schema(f"token_sequences array<array<int>>, metadata map<string,{SEQUENCE_META}>").option("multiLine", one_document).json(path)
    return doc.select(F.posexplode("token_sequences").alias("pos", "tokens"), "metadata").select("pos", "tokens", F.try_element_at("metadata", F.col("pos").cast("string")).alias("metadata"))


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """(tokens, source_file): lines that are objects with token_sequences, objects with tokens, or bare arrays."""
    lines = spark.read.text(path).where(F.trim("value") != "").withColumn("source_file", F.col("_metadata.file_path"))
    many = F.from_json("value", "struct<token_sequences:array<array<int>>>")["token_sequences"]
    one = F.from_json("value", "struct<tokens:array<int>>")["tokens"]
    bare = F.when(F.startswith(F.ltrim("value"), F.lit("[")), F.from_json("value", "array<int>"))
    return lines.select(F.explode(F.coalesce(many, F.array(F.coalesce(one, bare)))).alias("tokens"), "source_file").where("tokens is not null")


def parse_log_blocks(text: Column, end: str = "---COMMIT_END---") -> Column:
    """Array of (hash, author, timestamp, subject, body): blocks between end marks; blocks of fewer than four lines are left out."""
    blocks = F.filter(F.transform(F.split(text, end), lambda b: F.filter(F.split(b, "\n"), lambda x: F.trim(x) != "")), lambda x: F.size(x) >= 4)
    return F.transform(
        blocks,
        lambda x: F.struct(F.get(x, F.lit(0)).alias("hash"), F.get(x, F.lit(1)).alias("author"), F.get(x, F.lit(2)).alias("timestamp"), F.get(x, F.lit(3)).alias("subject"), F.array_join(F.slice(x, 5, 5), "\n").alias("body")),
    )


def parse_nul_record(record: Column) -> Column:
    """Fields of a record separated by NUL."""
    return F.split(record, "\\x00")


def read_tree(spark: SparkSession, path: str, suffixes: tuple[str, ...] = (), exclude: tuple[str, ...] = (".git", "target", "node_modules"), max_bytes: int = 1_000_000, least_chars: int = 0) -> DataFrame:
    """(path, length, text): text files below a folder; binary files (a NUL in the first KiB) and excluded folders are left out.

    Text is UTF-8, or Latin-1 where it is not.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if suffixes:
        reader = reader.option("pathGlobFilter", "*.{" + ",".join(suffixes) + "}")
    root = path.rstrip("/")
    files = reader.load(path).where(F.col("length") <= max_bytes)
    rel = F.regexp_replace("path", "^.*?" + root.replace(".", r"\.") + "/", "")
    files = files.withColumn("path", rel).where(~F.col("path").rlike("(^|/)(" + "|".join(e.replace(".", r"\.") for e in exclude) + "|\\.[^/]*)(/|$)"))
    files = files.where(~F.decode(F.substring(F.col("content"), 1, 1024), "ISO-8859-1").contains("\x00"))
    utf8 = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    return files.select("path", "length", F.coalesce(utf8, F.decode("content", "ISO-8859-1")).alias("text")).where(F.length("text") >= least_chars)


def line_chunks(files: DataFrame, size: int = 200, overlap: int = 40, **constants: str) -> DataFrame:
    """(path, start_line, end_line, total_lines, text) windows of lines of each file, with constant columns for branch or commit."""
    from tessera.functions.code import split_lines
    from tessera.operators.windows import line_windows

    rows = files.withColumn("l_", split_lines(F.col("text")))
    w = rows.withColumn("w_", F.explode(line_windows(F.col("l_"), size, overlap)))
    out = w.select("path", F.col("w_.start_line").alias("start_line"), F.col("w_.end_line").alias("end_line"), F.size("l_").alias("total_lines"), F.array_join(F.slice("l_", F.col("w_.start_line").cast("int"), (F.col("w_.end_line") - F.col("w_.start_line") + 1).cast("int")), "\n").alias("text"))
    return out.withColumns({k: F.lit(v) for k, v in constants.items()}) if constants else out


def read_metrics(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    return (spark.readStream if stream else spark.read).schema(METRICS).json(path)


def read_lines(spark: SparkSession, path: str, sha256: str | None = None) -> DataFrame:
    """Lines of text files; with a digest, files of another content are refused."""
    if sha256 is not None:
        bad = spark.read.format("binaryFile").load(path).where(F.sha2("content", 256) != sha256.lower())
        if not bad.isEmpty():
            raise ValueError("the digest of a file differs")
    return spark.read.text(path)


def load_config(text: str, defaults: dict | None = None) -> dict:
    """Settings of a YAML subset (nested keys, scalars, flat lists), over defaults; PyYAML is used where it is installed."""
    try:
        import yaml

        found = yaml.safe_load(text) or {}
    except ImportError:
        found = _parse_settings(text)

    def merged(a: dict, b: dict) -> dict:
        return {**a, **{k: merged(a[k], v) if isinstance(v, dict) and isinstance(a.get(k), dict) else v for k, v in b.items()}}

    return merged(defaults or {}, found)


def _scalar(v: str):
    v = v.strip()
    if v[:1] in "\"'" and v[-1:] == v[:1] and len(v) > 1:
        return v[1:-1]
    if v.startswith("[") and v.endswith("]"):
        return [_scalar(x) for x in v[1:-1].split(",") if x.strip()]
    low = v.lower()
    if low in ("true", "false"):
        return low == "true"
    if low in ("", "null", "~"):
        return None
    for kind in (int, float):
        try:
            return kind(v)
        except ValueError:
            pass
    return v


def _parse_settings(text: str) -> dict:
    root: dict = {}
    stack: list[tuple[int, dict | list, object]] = [(-1, root, None)]
    for raw in text.splitlines():
        line = raw.split(" #")[0].rstrip()
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        depth = len(line) - len(line.lstrip())
        body = line.strip()
        while depth <= stack[-1][0] and not (body.startswith("- ") and isinstance(stack[-1][1], list)):
            stack.pop()
        holder = stack[-1][1]
        if body.startswith("- "):
            if isinstance(holder, dict) and not holder and stack[-1][2] is not None:  # an empty value turns out to be a list
                parent, key = stack[-1][2]
                holder = parent[key] = []
                stack[-1] = (stack[-1][0], holder, stack[-1][2])
            holder.append(_scalar(body[2:]))
            continue
        key, _, value = body.partition(":")
        if value.strip():
            holder[key.strip()] = _scalar(value)
        else:
            holder[key.strip()] = {}
            stack.append((depth, holder[key.strip()], (holder, key.strip())))
    return root
