import gzip
import http.server
import json
import struct
import threading
from urllib.error import HTTPError

import pytest
from pyspark.sql import functions as F

from loamworks.functions.text import format_bytes, is_blank, is_shard, pretokens
from loamworks.operators import progress
from loamworks.operators.sample import prefix, read_sample
from loamworks.sources import files, scan
from loamworks.streaming.records import stream

ACCEPT = {
    "a.jsonl": (1, 1, 0), "a.jsonl.gz": (1, 1, 1), "a.ndjson": (1, 1, 0), "a.txt": (1, 0, 0), "a.txt.gz": (1, 0, 1),
    "Log.TXT.GZ": (1, 0, 1), "a.parquet": (0, 0, 0), "a.json": (0, 0, 0), "README.md": (0, 0, 0), "a.gz": (0, 0, 1), "b.text": (1, 0, 0),
}


def texts(spark, paths, **more):
    return [r.text for r in scan.records(spark, [str(p) for p in paths], **more).orderBy("file_ord", "pos").collect()]


def test_names(spark):
    for n, (ok, is_json, zipped) in ACCEPT.items():
        assert files.is_corpus_file(n) == bool(ok)
        assert files.detect_format(n) == files.Format(bool(is_json), bool(zipped))
    rows = spark.createDataFrame([(n,) for n in ACCEPT], "name string").filter(is_shard(F.col("name"))).collect()
    assert {r.name for r in rows} == {n for n, v in ACCEPT.items() if v[0]}


def test_sweep(tmp_path):
    with pytest.raises(FileNotFoundError, match="no corpus files"):
        files.local_files(tmp_path)
    with pytest.raises(FileNotFoundError):
        files.local_files(tmp_path / "missing")
    for n in ("b.jsonl", "a.txt", "c.parquet", "_x.txt"):
        (tmp_path / n).write_text("x")
    (tmp_path / "sub.txt").mkdir()
    assert [p.rsplit("/", 1)[-1] for p in files.local_files(tmp_path)] == ["_x.txt", "a.txt", "b.jsonl"]
    assert files.local_files(tmp_path / "c.parquet") == [str(tmp_path / "c.parquet")]


def test_remote_source(tmp_path):
    mirror, cache = tmp_path / "mirror", tmp_path / "cache"
    (mirror / "o/r/main").mkdir(parents=True)
    for n in ("b.jsonl", "a.txt", "x.md"):
        (mirror / "o/r/main" / n).write_text(n)
    assert files.RemoteSource("o/r", files=("z.jsonl", "a.gz")).names() == ["z.jsonl", "a.gz"]
    s = files.RemoteSource("o/r", cache_dir=str(cache), lister=files.folder_lister(mirror), transport=files.folder_transport(mirror))
    assert s.names() == ["a.txt", "b.jsonl"]
    with pytest.raises(FileNotFoundError, match="download"):
        s.resolve()
    p = progress.Progress()
    assert s.download(p) == s.resolve() and (p.downloaded, p.hits, p.run_bytes) == (2, 0, 12)
    p = progress.Progress()
    s.download(p)
    assert (p.downloaded, p.hits, p.total) == (0, 2, 2)


def test_two_shards(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "rye"}\n{"text": "oat"}\n{"meta": 1}\n')
    with gzip.open(tmp_path / "b.jsonl.gz", "wt") as f:
        f.write('{"text": "bran"}\n')
    assert texts(spark, files.local_files(tmp_path)) == ["rye", "oat", "bran"]


def test_line_ends_blanks_and_bad_bytes(spark, tmp_path):
    (tmp_path / "x.txt").write_bytes("one\r\ntwo\rthree\n\xa0  \n  \n  kept \nb".encode() + b"ad\xff\xfe\nlast".replace(b"b", b""))
    assert texts(spark, [tmp_path / "x.txt"]) == ["one", "two\rthree", "  kept ", "last"]


def test_hidden_names_and_members(spark, tmp_path):
    (tmp_path / "_x.txt").write_text("under\nscore\n")
    (tmp_path / "y z+1.txt.gz").write_bytes(gzip.compress(b"m1\n") + gzip.compress(b"m2\n"))
    assert texts(spark, [tmp_path / "_x.txt", tmp_path / "y z+1.txt.gz"]) == ["under", "score", "m1", "m2"]
    assert sorted(texts(spark, [tmp_path / "_x.txt"])) == ["score", "under"]
    assert texts(spark, [tmp_path / "y z+1.txt.gz"]) == ["m1", "m2"]


def test_a_cut_gzip_keeps_its_start(spark, tmp_path):
    import random

    whole = gzip.compress("".join(f"line {i} {random.Random(i).random()}\n" for i in range(20_000)).encode())
    (tmp_path / "c.txt.gz").write_bytes(whole[: len(whole) // 2])
    assert 1000 < len(texts(spark, [tmp_path / "c.txt.gz"])) < 20_000


JSON = {
    '{"text": "barley", "meta": 1}': ("barley", False), '{"meta": 1}': (None, False), '{"text": ""}': (None, False), "   ": (None, False),
    "{cut short": (None, True), '{"text": 1}': (None, False), '{"text": {"a": 1}}': (None, False), '{"text": null}': (None, False),
    "[1]": (None, False), '"text"': (None, False), "{'text': 'x'}": (None, True), '{"text": "a", "text": "b"}': ("b", False),
    '{"text": "  "}': ("  ", False), '{"text": "x",}': (None, True),
}


@pytest.mark.parametrize("f", [scan.json_text, scan.json_text_strict])
def test_json_lines(spark, f):
    scan.configure(spark)
    rows = spark.createDataFrame([(k,) for k in JSON], "line string").select("line", f(F.col("line")).alias("r")).collect()
    assert {r.line: (r.r.text, r.r.malformed) for r in rows} == JSON


def test_strict_json_refuses_more(spark):
    lines = ['{"text": "x"} y', '{"text": "x", "n": 1e999}', '{"text": "\\ud800"}', '{"text": "x", "d": ' + "[" * 200 + "]" * 200 + "}"]
    rows = spark.createDataFrame([(k,) for k in lines], "line string").select(scan.json_text_strict(F.col("line")).alias("r")).collect()
    assert all(r.r.malformed and r.r.text is None for r in rows)


def test_a_field_is_a_literal_key(spark):
    row = spark.createDataFrame([('{"a.b": "dot", "a": {"b": "path"}}',)], "line string").select(scan.json_text(F.col("line"), "a.b").alias("r")).first()
    assert row.r.text == "dot"


def test_sample(spark):
    df = spark.createDataFrame([(i, "x" * 9) for i in range(50)], "k int, text string")
    for budget, n in ((0, 1), (1, 1), (10, 1), (11, 2), (100, 10), (10**6, 50)):
        assert prefix(df, ["k"], budget=budget).count() == n
    assert read_sample(df, ["k"], budget=11) == "xxxxxxxxx\n" * 2
    with pytest.raises(ValueError):
        read_sample(df.limit(0), ["k"])


def test_bytes_and_fold(spark):
    want = {0: "0 B", 512: "512 B", 1024: "1.0 KiB", 1280: "1.2 KiB", 1536: "1.5 KiB", 5 * 1024**2: "5.0 MiB", 3 * 1024**3: "3.0 GiB"}
    rows = spark.createDataFrame([(k,) for k in want], "b bigint").select("b", format_bytes(F.col("b")).alias("s")).collect()
    assert {r.b: r.s for r in rows} == want == {k: progress.format_bytes(k) for k in want}


def test_tensor_names(spark, tmp_path):
    head = json.dumps({"__metadata__": {"a": "b"}, "weight": {"dtype": "F32", "shape": [2], "data_offsets": [0, 8]}}).encode()
    (tmp_path / "w.safetensors").write_bytes(struct.pack("<Q", len(head)) + head + b"\0" * 8)
    assert [r.name for r in files.tensor_names(spark, str(tmp_path / "w.safetensors")).collect()] == ["weight"]


def test_words_join_to_the_text(spark):
    own = ["", " two  spaces ", "tab\tand\n\nlines", "it's 3 o'clock—né 日本 🎉!!", " x y"]
    rows = spark.createDataFrame([(t,) for t in own], "t string").select("t", F.concat_ws("", pretokens(F.col("t"))).alias("j")).collect()
    assert all(r.t == r.j for r in rows)
    assert spark.createDataFrame([("  ",)], "t string").filter(is_blank(F.col("t"))).count() == 1


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text('{"text": "rye"}\n{bad\n{"text": 3}\n')
    q = stream(spark, str(tmp_path / "in"), True).writeStream.format("memory").queryName("seen").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [r.text for r in spark.table("seen").collect()] == ["rye"]


def test_paths_that_end_alike(spark, tmp_path, monkeypatch):
    """Relative paths, one name as the end of another, a path given twice, odd characters: each line once."""
    for n in ("x.txt", "yx.txt", "a b+c%20.txt", "sub/x.txt"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_text(f"line of {n}\n")
    monkeypatch.chdir(tmp_path)
    uri = (tmp_path / "sub/x.txt").as_uri()
    paths = ["x.txt", "yx.txt", str(tmp_path / "a b+c%20.txt"), "yx.txt", uri]
    found = scan.lines(spark, paths)
    assert sorted((r.file_ord, r.value) for r in found.collect()) == [
        (0, "line of x.txt"), (1, "line of yx.txt"), (2, "line of a b+c%20.txt"), (4, "line of sub/x.txt"),
    ]
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_download_sizes(tmp_path):
    (tmp_path / "m/o/r/main").mkdir(parents=True)
    (tmp_path / "m/o/r/main/a.txt").write_text("12345")
    told = []

    class Told(files.Reporter):
        def started(self, name, total, size):
            told.append((name, total, size))

    mirror = tmp_path / "m"
    source = files.RemoteSource("o/r", cache_dir=str(tmp_path / "c"), lister=files.folder_lister(mirror), transport=files.folder_transport(mirror), sizer=files.folder_sizer(mirror))
    source.download(Told())
    assert told == [("a.txt", 1, 5)]


def test_prefix_by_sums_of_ranges(spark, monkeypatch):
    """Ties, nulls in the order, two order columns, very long texts, any budget: against a plain loop."""
    import random

    r = random.Random(4)
    rows = [(r.choice([None, 1, 2, 3]), r.randint(0, 40), "é" * r.choice([0, 1, 5, 30])) for _ in range(300)]
    rows += [(0, 7, "y" * 1_000_000), (2, 50, "z" * 1_000_000), (1, 1, None), *[(1, 20, "same")] * 30]
    df = spark.createDataFrame(rows, "a int, b int, text string").repartition(5)
    whole = [(x.a, x.b, x.text) for x in df.filter(F.length("text") > 0).orderBy("a", "b", F.xxhash64("text")).collect()]
    for budget in (1, 50, 1700, 5000, 1_000_100, 3_000_000):
        want, total = [], 0
        for x in whole:
            if total >= budget:
                break
            want.append(x)
            total += len(x[2]) + 1
        got = [tuple(x) for x in prefix(df, ["a", "b"], budget=budget).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr), budget
    plan = prefix(df, ["a", "b"], budget=1700)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "TakeOrdered" not in plan


def test_drops_are_counted(spark, tmp_path, caplog):
    (tmp_path / "a.jsonl").write_bytes(b'{"text": "one"}\n{"text"\n\n{"n": 1}\n  \n{"text": ""}\n\xff\xfe\n{"text": "two"}\n')
    (tmp_path / "b.txt").write_bytes("﻿three\n\n \nfour\r\n".encode() + b"\xc3\n")
    with gzip.open(tmp_path / "_c.ndjson.gz", "wb") as f:
        f.write(b'\xef\xbb\xbf{"text": "five"}\n{bad\n')
    (tmp_path / "d.txt").write_bytes(b"")
    (tmp_path / "e.jsonl.gz").write_bytes(b"no gzip at all")
    paths = [*files.local_files(tmp_path), str(tmp_path / "missing.txt")]
    for strict in (False, True):
        drops = scan.Drops()
        got = scan.records(spark, paths, strict=strict, drops=drops).collect()
        assert sorted(r.text for r in got) == ["five", "four", "one", "three", "two"]
        want = {"lines": 15, "not_utf8": 2, "blank": 4, "malformed": 2, "textless": 2, "silent_files": 3}
        assert drops.counts() == want
    drops.warn()
    assert {r.message for r in caplog.records} >= {"skipped 2 not utf8", "skipped 2 malformed", "skipped 3 silent files"}


def test_shards_are_written_and_found(spark, tmp_path):
    df = spark.createDataFrame([("one\ntwo",), ("é",), (None,), ("",)], "text string").repartition(2)
    for ending, want in ((".jsonl", ["one\ntwo", "é"]), (".ndjson.gz", ["one\ntwo", "é"]), (".TXT.gz", ["one", "two", "é"])):
        paths = files.write_shards(df, str(tmp_path / f"x{ending}"), ending)
        assert paths == files.shards(spark, str(tmp_path / f"x{ending}")) and all(p.endswith(ending) for p in paths)
        assert sorted(texts(spark, paths)) == sorted(want)
    with pytest.raises(ValueError, match="ending"):
        files.write_shards(df, str(tmp_path / "y"), ".parquet")
    assert not [p for p in tmp_path.iterdir() if p.name.endswith(".part")]


def test_headers_alone_are_read(spark, tmp_path):
    """A file of 3 GB, sparse, and a broken one; a folder of files."""
    import time

    for k in range(3):
        head = json.dumps({f"w{k}": {"dtype": "F16", "shape": [3, k], "data_offsets": [0, 6]}, "__metadata__": {}}).encode()
        with open(tmp_path / f"{k}.safetensors", "wb") as f:
            f.write(struct.pack("<Q", len(head)) + head)
            f.truncate(3 << 30 if k == 0 else 4096)
    began = time.monotonic()
    got = files.tensor_names(spark, str(tmp_path)).collect()
    assert sorted((r.name, r.dtype, r.shape) for r in got) == [(f"w{k}", "F16", [3, k]) for k in range(3)]
    assert time.monotonic() - began < 30
    (tmp_path / "bad.safetensors").write_bytes(struct.pack("<Q", 50) + b"{}")
    with pytest.raises(ValueError, match="ends within"):
        files.tensor_names(spark, str(tmp_path / "bad.safetensors"))


def test_artifact_on_a_file_system_of_spark(spark, tmp_path, monkeypatch):
    from loamworks.operators import bpe

    t = bpe.Tokenizer(((b"a", b"b"), (b"ab", b"\xff")))
    at = f"file://{tmp_path}/deep/tokenizer.json"
    t.save(at, spark)
    t.save(at, spark)
    assert bpe.Tokenizer.load(at, spark) == t == bpe.Tokenizer.load(f"{tmp_path}/deep/tokenizer.json")
    folder = f"file://{tmp_path}/whole"
    for _ in range(2):
        t.save_folder(spark, folder)
    assert bpe.Tokenizer.load(folder + "/tokenizer.json", spark) == t
    rows = spark.read.parquet(folder + "/merges").orderBy("rank").collect()
    assert tuple((bytes(r.left), bytes(r.right)) for r in rows) == t.merges
    assert spark.read.parquet(folder + "/vocabulary").count() == t.vocab_size()

    def fails(*_):
        raise OSError("lost")

    monkeypatch.setattr(bpe, "rename", fails)
    with pytest.raises(OSError, match="lost"):
        t.save_folder(spark, f"file://{tmp_path}/never")
    assert {p.name for p in tmp_path.iterdir()} == {"deep", "whole"}


class Hub(http.server.BaseHTTPRequestHandler):
    """A hub with faults: it breaks off every first answer, and is busy once."""

    files: dict[str, bytes] = {}
    ranges, seen, broken, busy = True, [], set(), {"a.txt"}

    def do_HEAD(self):
        self._answer(False)

    def do_GET(self):
        self._answer(True)

    def _answer(self, body):
        kind = type(self)
        kind.seen.append((self.command, self.path, self.headers.get("Range"), self.headers.get("Authorization")))
        if self.path == "/api/datasets/o/r/revision/v%2F1":
            data = json.dumps({"siblings": [{"rfilename": n} for n in kind.files]}).encode()
        else:
            name = self.path.removeprefix("/datasets/o/r/resolve/v%2F1/").replace("%20", " ")
            if name in kind.busy:
                kind.busy.discard(name)
                self.send_error(503)
                return
            if name not in kind.files:
                self.send_error(404)
                return
            data = kind.files[name]
        start = int(self.headers["Range"][6:-1]) if kind.ranges and self.headers.get("Range") else 0
        self.send_response(206 if start else 200)
        self.send_header("Content-Length", str(len(data) - start))
        self.end_headers()
        if body:
            cut = len(data) // 2 if self.path not in kind.broken and "/resolve/" in self.path and len(data) > 100 else len(data)
            kind.broken.add(self.path)
            self.wfile.write(data[start:cut])

    def log_message(self, *_):
        pass


@pytest.mark.parametrize("ranges", [True, False])
def test_a_hub_over_http(tmp_path, monkeypatch, capsys, ranges):
    """Listing, sizes, broken connections gone on with, a busy server, a missing file; by the command too."""
    from loamworks import cli

    monkeypatch.setattr(files, "WAIT", 0.01)
    Hub.files = {"a.txt": b"one\n" * 500_000, "sub/b c.jsonl": b'{"text": "two"}\n' * 9, "README.md": b"no"}
    Hub.ranges, Hub.seen, Hub.broken, Hub.busy = ranges, [], set(), {"a.txt"}
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Hub)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    hub = f"http://127.0.0.1:{server.server_port}"
    try:
        way = {"lister": files.http_lister(hub, "secret"), "transport": files.http_transport(hub, "secret"), "sizer": files.http_sizer(hub)}
        s = files.RemoteSource("o/r", "v/1", cache_dir=str(tmp_path / "x"), **way)
        assert s.names() == ["a.txt", "sub/b c.jsonl"]
        p = progress.Progress()
        paths = s.download(p)
        assert [open(x, "rb").read() for x in paths] == [Hub.files["a.txt"], Hub.files["sub/b c.jsonl"]]
        assert paths == s.resolve() and p.downloaded == 2
        asked = [x for x in Hub.seen if x[0] == "GET" and x[1].endswith("a.txt")]
        assert asked[-1][2] == "bytes=1000000-" and asked[-1][3] == "Bearer secret"
        assert p.run_bytes >= 2_000_144 and (p.run_bytes == 2_000_144 or not ranges)
        with pytest.raises(HTTPError):
            files.RemoteSource("o/r", "v/1", ("missing.txt",), str(tmp_path / "x"), **way).download()
        assert not [x for x in (tmp_path / "x").rglob("*") if x.name == "missing.txt"]
        assert cli.main(["download", "--hf-repo", "o/r", "--hf-revision", "v/1", "--cache-dir", str(tmp_path / "y"), "--endpoint", hub]) == 0
        assert "2 files: 2 downloaded" in capsys.readouterr().out
    finally:
        server.shutdown()
