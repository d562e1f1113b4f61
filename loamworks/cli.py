"""Command line: download, tokenizer, train, generate, serve."""

from __future__ import annotations

import argparse
import logging
import os
import sys

from .operators import codec
from .operators.bpe import MIN_FREQUENCY, VOCAB_SIZE, train, vocab_size_from_file
from .operators.config import SIZES, load_model_config, read_env
from .operators.progress import Progress, format_bytes
from .operators.sample import read_sample
from .sources.files import LocalSource, RemoteSource, folder_lister, folder_sizer, folder_transport, http_lister, http_sizer, http_transport
from .sources.scan import Drops, records

log = logging.getLogger("loamworks")


def _flag(x: str) -> bool:
    if x not in ("true", "false"):
        raise argparse.ArgumentTypeError("true or false")
    return x == "true"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loamworks")
    p.add_argument("--log-level", default=os.environ.get("LOAMWORKS_LOG_LEVEL", "INFO"))
    sub = p.add_subparsers(dest="command")

    def remote(q: argparse.ArgumentParser) -> None:
        q.add_argument("--hf-revision", default="main")
        q.add_argument("--hf-file", action="append", default=[])
        q.add_argument("--cache-dir")
        q.add_argument("--mirror", help="folder that mirrors the datasets, as <repo>/<revision>/")
        q.add_argument("--endpoint", default=os.environ.get("HF_ENDPOINT", "https://huggingface.co"), help="hub to list and fetch from without a mirror")

    d = sub.add_parser("download")
    d.add_argument("--hf-repo", required=True)
    remote(d)
    t = sub.add_parser("tokenizer")
    one = t.add_mutually_exclusive_group(required=True)
    one.add_argument("--input")
    one.add_argument("--hf-repo")
    remote(t)
    t.add_argument("--text-field", default="text")
    t.add_argument("--output", default="tokenizer.json")
    t.add_argument("--vocab-size", type=int, default=VOCAB_SIZE)
    t.add_argument("--min-frequency", type=int, default=MIN_FREQUENCY)
    r = sub.add_parser("train")
    r.add_argument("--config")
    r.add_argument("--size", choices=sorted(SIZES), default="gpt2-small")
    r.add_argument("--tokenizer")
    for name in ("vocab-size", "context-length", "d-model", "d-ff", "num-layers", "num-heads"):
        r.add_argument(f"--{name}", type=int)
    r.add_argument("--norm-first", type=_flag)
    g = sub.add_parser("generate")
    g.add_argument("prompt")
    g.add_argument("--weights")
    s = sub.add_parser("serve")
    s.add_argument("--weights")
    s.add_argument("--port", type=int, default=8080)
    return p


def remote_source(a: argparse.Namespace) -> RemoteSource:
    """From a mirror, else from a hub; a token in HF_TOKEN goes with its requests."""
    if a.mirror:
        ways = folder_lister(a.mirror), folder_transport(a.mirror), folder_sizer(a.mirror)
    else:
        hub = a.endpoint, os.environ.get("HF_TOKEN")
        ways = http_lister(*hub), http_transport(*hub), http_sizer(*hub)
    return RemoteSource(a.hf_repo, a.hf_revision, tuple(a.hf_file), a.cache_dir, *ways)


def read_prompt(prompt: str) -> str:
    return sys.stdin.read() if prompt == "-" else prompt


def train_tokenizer(spark, source, text_field: str, output: str, vocab_size: int, min_frequency: int) -> codec.Report:  # noqa: ANN001
    """Reads, trains, verifies, then saves; fails on an empty corpus before it trains."""
    paths = source.resolve()
    sample = read_sample(records(spark, paths, text_field), ["file_ord", "pos"])
    drops = Drops()
    tokenizer = train(records(spark, paths, text_field, drops=drops), vocab_size, min_frequency)
    drops.warn()
    report = codec.report(tokenizer, sample)
    if not report.in_band:
        log.warning("%.2f characters a token lie outside %s to %s", report.chars_per_token, codec.LOW, codec.HIGH)
    tokenizer.save(output)
    return report


def resolve_train(a: argparse.Namespace, env: dict):  # noqa: ANN201
    names = ("vocab_size", "context_length", "d_model", "d_ff", "num_layers", "num_heads", "norm_first")
    vocab = vocab_size_from_file(a.tokenizer) if a.tokenizer else None
    return load_model_config(SIZES[a.size], a.config, env, {n: getattr(a, n) for n in names}, vocab)


def main(argv: list[str] | None = None) -> int:
    p = parser()
    a = p.parse_args(argv)
    logging.basicConfig(level=a.log_level.upper())
    if a.command is None:
        p.print_help()
    elif a.command == "download":
        progress = Progress()
        source = remote_source(a)
        paths = source.download(progress)
        print(f"{len(paths)} files: {progress.downloaded} downloaded ({format_bytes(progress.run_bytes)}), {progress.hits} cached in {source.cache_location()}")
    elif a.command == "tokenizer":
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("loamworks").getOrCreate()
        source = LocalSource(a.input) if a.input else remote_source(a)
        r = train_tokenizer(spark, source, a.text_field, a.output, a.vocab_size, a.min_frequency)
        print(f"{a.output}: {r.vocab_size} tokens, {r.chars_per_token:.2f} characters a token, round trip {r.round_trips}")
    elif a.command == "train":
        log.info("%s", resolve_train(a, read_env()))
        raise NotImplementedError("training is not implemented")
    elif a.command == "generate":
        read_prompt(a.prompt)
        raise NotImplementedError("generation is not implemented")
    else:
        raise NotImplementedError("serving is not implemented")
    return 0


if __name__ == "__main__":
    sys.exit(main())
