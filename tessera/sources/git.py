"""A data source over git repositories: one partition per slice of history, read by the git client.

Register with ``spark.dataSource.register(GitCommits)`` and read with
``spark.read.format("git_commits").option("repository", path).load()``.
"""

from __future__ import annotations

import subprocess
from collections.abc import Iterator, Sequence

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_FORMAT = "%H%x00%h%x00%P%x00%an%x00%ae%x00%at%x00%cn%x00%ce%x00%ct%x00%B%x00%x01"


class _Slice(InputPartition):
    def __init__(self, skip: int, count: int):
        self.skip, self.count = skip, count


def _git(repository: str, *args: str) -> str:
    return subprocess.run(["git", "-C", repository, *args], capture_output=True, text=True, errors="replace", check=True).stdout


class GitCommits(DataSource):
    """Commits of all refs: hashes, people, times, subject and body."""

    @classmethod
    def name(cls) -> str:
        return "git_commits"

    def schema(self) -> str:
        return "hash string, abbrev_hash string, parents array<string>, author_name string, author_email string, author_timestamp bigint, committer_name string, committer_email string, commit_timestamp bigint, subject string, body string, is_merge boolean"

    def reader(self, schema) -> DataSourceReader:
        return _CommitReader(self.options)


class _CommitReader(DataSourceReader):
    def __init__(self, options):
        self.repository = options["repository"]
        self.slices = int(options.get("slices", "4"))

    def partitions(self) -> Sequence[InputPartition]:
        total = int(_git(self.repository, "rev-list", "--all", "--count").strip() or 0)
        size = max(1, -(-total // self.slices))
        return [_Slice(i, size) for i in range(0, max(total, 1), size)]

    def read(self, partition: _Slice) -> Iterator[tuple]:
        out = _git(self.repository, "log", "--all", f"--skip={partition.skip}", f"--max-count={partition.count}", f"--format={_FORMAT}")
        for record in out.split("\x01"):
            f = record.strip("\n").split("\x00")
            if len(f) < 10:
                continue
            subject, _, body = f[9].partition("\n")
            parents = f[2].split()
            yield (f[0], f[1], parents, f[3], f[4], int(f[5]), f[6], f[7], int(f[8]), subject.strip(), body.strip(), len(parents) > 1)


class GitDiffs(DataSource):
    """Per-file changes of all commits against their first parent."""

    @classmethod
    def name(cls) -> str:
        return "git_diffs"

    def schema(self) -> str:
        return "commit_hash string, change_type string, old_file string, filename string, additions bigint, deletions bigint, is_binary boolean"

    def reader(self, schema) -> DataSourceReader:
        return _DiffReader(self.options)


class _DiffReader(_CommitReader):
    def read(self, partition: _Slice) -> Iterator[tuple]:
        base = ("log", "--all", "--first-parent", "-m", "--root", "-M", f"--skip={partition.skip}", f"--max-count={partition.count}", "--format=%x01%H")
        kinds: dict[tuple[str, str], tuple[str, str]] = {}
        for block in _git(self.repository, *base, "--name-status").split("\x01")[1:]:
            head, *lines = block.strip("\n").split("\n")
            for line in lines:
                parts = line.split("\t")
                if len(parts) >= 2:
                    kinds[head, parts[-1]] = (parts[0][:1], parts[1] if len(parts) > 2 else parts[-1])
        for block in _git(self.repository, *base, "--numstat", "-z").split("\x01")[1:]:
            fields = block.split("\x00")
            head, rest = fields[0].strip("\n"), [x.strip("\n") for x in fields[1:] if x.strip("\n")]
            i = 0
            while i < len(rest):
                cols = rest[i].split("\t")
                if len(cols) < 3:
                    i += 1
                    continue
                name = cols[2]
                if not name and i + 2 < len(rest):  # a rename lists both names after the counts
                    name, i = rest[i + 2], i + 2
                binary = cols[0] == "-"
                kind, old = kinds.get((head, name), ("M", name))
                yield (head, kind, old, name, 0 if binary else int(cols[0]), 0 if binary else int(cols[1]), binary)
                i += 1
