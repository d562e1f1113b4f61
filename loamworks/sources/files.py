"""Where the shards of a corpus are: local files, or the cache of a pinned remote dataset."""

from __future__ import annotations

import json
import os
import re
import shutil
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from http.client import IncompleteRead
from pathlib import Path
from urllib.error import HTTPError, URLError
from urllib.parse import quote
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import listed, read_file, rename

_SHARD = re.compile(r"\.(jsonl|ndjson|txt|text)(\.gz)?$", re.I | re.A)


@dataclass(frozen=True)
class Format:
    json: bool
    gzip: bool


def detect_format(path: str | Path) -> Format:
    """By the extension alone, in any case."""
    name = Path(path).name.lower()
    gzip = name.endswith(".gz")
    base = name.removesuffix(".gz")
    return Format(base.endswith((".jsonl", ".ndjson")), gzip)


def is_corpus_file(name: str) -> bool:
    return bool(_SHARD.search(name))


def local_files(path: str | Path) -> list[str]:
    """A file as it is, whatever its extension; of a directory the shards in it, sorted."""
    p = Path(path)
    if p.is_file():
        return [str(p)]
    if not p.is_dir():
        raise FileNotFoundError(f"no such file or directory: {p}")
    found = []
    for entry in os.scandir(p):
        try:
            if entry.is_file() and is_corpus_file(entry.name):
                entry.name.encode("utf-8")
                found.append(entry.path)
        except (OSError, UnicodeEncodeError):
            continue
    if not found:
        raise FileNotFoundError(f"no corpus files (.jsonl .ndjson .txt .text, or these with .gz) in {p}")
    return sorted(found)


class Reporter:
    """Receives the events of a download; override what is of interest."""

    def started(self, name: str, total: int, size: int) -> None: ...
    def advanced(self, size: int) -> None: ...
    def finished(self, name: str) -> None: ...
    def cached(self, name: str, total: int) -> None: ...


Lister = Callable[[str, str], list[str]]
Transport = Callable[[str, str, str, Path, Callable[[int], None]], None]
#: Bytes of a file before it is fetched; 0 if nobody knows.
Sizer = Callable[[str, str, str], int]


def folder_lister(root: str | Path) -> Lister:
    """Lists a dataset mirrored under root/<repo>/<revision>."""
    return lambda repo, revision: [
        str(p.relative_to(Path(root, repo, revision))) for p in Path(root, repo, revision).rglob("*") if p.is_file()
    ]


def folder_transport(root: str | Path) -> Transport:
    """Copies from root/<repo>/<revision>; a transport over a network has the same shape."""

    def copy(repo: str, revision: str, name: str, to: Path, advanced: Callable[[int], None]) -> None:
        with open(Path(root, repo, revision, name), "rb") as a, open(to, "wb") as b:
            while part := a.read(1 << 20):
                b.write(part)
                advanced(len(part))

    return copy


def folder_sizer(root: str | Path) -> Sizer:
    return lambda repo, revision, name: Path(root, repo, revision, name).stat().st_size


#: Attempts at a request, and the seconds before the second one; each later wait is twice as long.
ATTEMPTS, WAIT = 5, 0.5
TIMEOUT = 60


def _retried(attempt: Callable[[], object]) -> object:
    """What the attempt gives; a fault of the network or the server is tried again, an answer such as 404 is not."""
    for k in range(ATTEMPTS):
        try:
            return attempt()
        except HTTPError as e:
            if e.code < 500 and e.code != 429 or k == ATTEMPTS - 1:
                raise
        except (URLError, TimeoutError, ConnectionError, IncompleteRead):
            if k == ATTEMPTS - 1:
                raise
        time.sleep(WAIT * 2**k)
    raise AssertionError


def _request(url: str, token: str | None, method: str = "GET", **headers: str) -> Request:
    return Request(url, method=method, headers={k.replace("_", "-"): v for k, v in headers.items()} | ({"Authorization": f"Bearer {token}"} if token else {}))


def _file_url(endpoint: str, repo: str, revision: str, name: str) -> str:
    return f"{endpoint.rstrip('/')}/datasets/{quote(repo)}/resolve/{quote(revision, safe='')}/{quote(name)}"


def http_lister(endpoint: str, token: str | None = None) -> Lister:
    """Lists a dataset by the public hub API: the names of the siblings of a revision."""

    def names(repo: str, revision: str) -> list[str]:
        def ask() -> list[str]:
            url = f"{endpoint.rstrip('/')}/api/datasets/{quote(repo)}/revision/{quote(revision, safe='')}"
            with urlopen(_request(url, token), timeout=TIMEOUT) as r:
                return [x["rfilename"] for x in json.load(r)["siblings"]]

        return _retried(ask)

    return names


def http_sizer(endpoint: str, token: str | None = None) -> Sizer:
    def size(repo: str, revision: str, name: str) -> int:
        def ask() -> int:
            with urlopen(_request(_file_url(endpoint, repo, revision, name), token, "HEAD"), timeout=TIMEOUT) as r:
                return int(r.headers.get("Content-Length") or 0)

        return _retried(ask)

    return size


def http_transport(endpoint: str, token: str | None = None) -> Transport:
    """Fetches a file in parts; what a broken connection left behind is kept, and the rest asked for."""

    def fetch(repo: str, revision: str, name: str, to: Path, advanced: Callable[[int], None]) -> None:
        url, done = _file_url(endpoint, repo, revision, name), 0
        with open(to, "wb") as f:

            def ask() -> None:
                nonlocal done
                more = {"Range": f"bytes={done}-"} if done else {}
                with urlopen(_request(url, token, **more), timeout=TIMEOUT) as r:
                    if done and r.status != 206:
                        # The server knows no ranges: from the start, and what was told of stays told.
                        f.seek(0)
                        f.truncate()
                        done = 0
                    left = int(r.headers["Content-Length"]) if r.headers.get("Content-Length") else None
                    while part := r.read(1 << 20):
                        f.write(part)
                        done += len(part)
                        left = None if left is None else left - len(part)
                        advanced(len(part))
                    if left:
                        raise IncompleteRead(b"", left)

            _retried(ask)

    return fetch


@dataclass(frozen=True)
class RemoteSource:
    """A dataset at a pinned revision; files empty means all its shards."""

    repo: str
    revision: str = "main"
    files: tuple[str, ...] = ()
    cache_dir: str | None = None
    lister: Lister | None = field(default=None, compare=False)
    transport: Transport | None = field(default=None, compare=False)
    sizer: Sizer | None = field(default=None, compare=False)

    def cache_location(self) -> Path:
        return Path(self.cache_dir or os.environ.get("LOAMWORKS_CACHE") or Path.home() / ".cache" / "loamworks")

    def cached_path(self, name: str) -> Path:
        return self.cache_location() / self.repo / self.revision / name

    def names(self) -> list[str]:
        """Explicit names as given, without a listing; else the listed shards, sorted."""
        if self.files:
            return list(self.files)
        if self.lister is None:
            raise ValueError("no files given, and no lister to ask for them")
        found = sorted(n for n in self.lister(self.repo, self.revision) if is_corpus_file(n))
        if not found:
            raise FileNotFoundError(f"no corpus files in {self.repo}@{self.revision}")
        return found

    def resolve(self) -> list[str]:
        """Paths in the cache; never downloads."""
        names = self.names()
        for n in names:
            if not self.cached_path(n).is_file():
                raise FileNotFoundError(f"{n} of {self.repo}@{self.revision} is not cached: run `download` first")
        return [str(self.cached_path(n)) for n in names]

    def download(self, reporter: Reporter | None = None) -> list[str]:
        """Fetches what the cache lacks, in order; a file appears in the cache only when whole."""
        reporter = reporter or Reporter()
        if self.transport is None:
            raise ValueError("no transport to download with")
        names = self.names()
        for n in names:
            to = self.cached_path(n)
            if to.is_file():
                reporter.cached(n, len(names))
                continue
            to.parent.mkdir(parents=True, exist_ok=True)
            part = to.with_name(to.name + ".part")
            reporter.started(n, len(names), self.sizer(self.repo, self.revision, n) if self.sizer else 0)
            self.transport(self.repo, self.revision, n, part, reporter.advanced)
            shutil.move(part, to)
            reporter.finished(n)
        return [str(self.cached_path(n)) for n in names]


@dataclass(frozen=True)
class LocalSource:
    path: str

    def resolve(self) -> list[str]:
        return local_files(self.path)


def cache_plan(wanted: DataFrame, cached: DataFrame) -> DataFrame:
    """name and action of wanted names: skip what is cached, fetch the rest."""
    have = cached.select("name").distinct()
    fetch = wanted.join(have, "name", "left_anti").select("name", F.lit("fetch").alias("action"))
    return fetch.union(wanted.join(have, "name", "left_semi").select("name", F.lit("skip").alias("action")))


#: Bytes of a header, at most; the format's own bound.
MOST_HEADER = 100_000_000
#: Files whose headers are read side by side.
READERS = 16


def tensor_header(spark: SparkSession, path: str) -> dict[str, dict]:
    """name: {dtype, shape, data_offsets} of a safetensors file: its first 8 bytes, and as many as they say."""
    size = int.from_bytes(read_file(spark, path, 0, 8), "little")
    if size > MOST_HEADER:
        raise ValueError(f"a header of {size} bytes: {path}")
    data = read_file(spark, path, 8, size)
    if len(data) < size:
        raise ValueError(f"the file ends within its header: {path}")
    found = json.loads(data)
    found.pop("__metadata__", None)
    return found


def tensor_names(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, dtype, shape) of every tensor in safetensors files, a folder's or a pattern's too; only headers are read."""
    # The listing is Spark's; it opens no file, as the content isn't asked for.
    paths = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    with ThreadPoolExecutor(READERS) as pool:
        headers = list(pool.map(lambda p: tensor_header(spark, p), paths))
    rows = [(p, k, v["dtype"], v["shape"]) for p, h in zip(paths, headers, strict=True) for k, v in h.items()]
    return spark.createDataFrame(rows, "path string, name string, dtype string, shape array<long>")


def shards(spark: SparkSession, folder: str) -> list[str]:
    """The shards of a folder on any file system that Spark reads, sorted."""
    found = [p for p in listed(spark, folder) if is_corpus_file(p.rsplit("/", 1)[-1])]
    if not found:
        raise FileNotFoundError(f"no corpus files in {folder}")
    return found


def write_shards(records: DataFrame, folder: str, ending: str = ".jsonl.gz", text: str = "text") -> list[str]:
    """Writes records as shards of a format, one line each, and gives their paths; plain text with line ends becomes several lines."""
    spark, kind = records.sparkSession, detect_format(ending)
    if not is_corpus_file("x" + ending):
        raise ValueError(f"no ending of a shard: {ending}")
    line = F.to_json(F.struct(F.col(text).alias("text"))) if kind.json else F.coalesce(text, F.lit(""))
    part = f"{folder}.{uuid.uuid4().hex}.part"
    records.select(line.alias("value")).write.option("compression", "gzip" if kind.gzip else "none").text(part)
    for i, p in enumerate(x for x in listed(spark, part) if x.rsplit("/", 1)[-1].startswith("part-")):
        rename(spark, p, f"{part}/shard-{i:05}{ending}")
    rename(spark, part, folder)
    return shards(spark, folder)
