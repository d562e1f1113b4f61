"""Token alignment against both libraries over whole texts and all pairs of tokens."""

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from public_tokenizers import path
from tokenizers import Tokenizer

from loamworks.llm import alignment, registry
from loamworks.llm.bpe import byte_letters

DOCS = "doc_id long, text string, block long, code int, n_a string, words int, sha string"


def rows():
    r = random.Random(9)
    parts = ["the", "The", "reading", "l'été", "d", "12", "3456", "...", "'s", "we'll", "日本語", "\U0001f600", "naïve", "Straße", "x_y", "<|endoftext|>", "<s>", "<0x0A>", "é", "{\r", "a;\r", "\x00", "ab" * 9]
    gaps = [" "] * 12 + ["\n", "\t", "\r\n", "  ", "   ", " \n ", " ", "  ", "  ", "　", "\x1c", "\x1c ", "\x0b", "\x0c ", "\x85", "", "\r", " \r"]
    text = lambda n: "".join(r.choice(parts) + r.choice(gaps) for _ in range(n))
    out = [(i, text(r.randint(1, 60))) for i in range(150)]
    out += [(200, None), (201, ""), (202, " "), (203, "\n"), (204, "a  "), (205, " \t\n "), (206, "lost ▁ mark"), (207, "▁"), (208, "x▁y the rest")]
    out += [(300 + i, "the same words again and again") for i in range(40)] + [(5, "id twice"), (None, "no id"), (None, None)]
    return [*out, (400, "long " * 9000), (401, "y" * 3000), (402, text(6000))]


class Libraries:
    def __init__(self):
        self.a = Tokenizer.from_file(path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
        back = {c: i for i, c in byte_letters().items()}
        self.bytes_a = {i: bytes(back[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}

    def bytes_b(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def tokens(self, text):
        """(id, start, end) of A and of B."""
        if not text:
            return [], []
        out = []
        for ids, of in ((self.a.encode(" " + text, add_special_tokens=False).ids, self.bytes_a.__getitem__), (self.b.encode(text), self.bytes_b)):
            own, at = [], 0
            for i in ids:
                own.append((i, at, at + len(of(i))))
                at = own[-1][2]
            if b"".join(of(i) for i in ids) != (" " + text).encode():
                return [], []
            out.append(own)
        return out


def expected(docs):
    both = Libraries()
    found = [both.tokens(t) for _, t in docs]
    links = []
    for a, b in found:
        own = []
        near = 0
        for i, s, e in a:
            while near and b[near - 1][2] > s:
                near -= 1
            while near < len(b) and b[near][2] <= s:
                near += 1
            k = near
            while k < len(b) and b[k][1] < e:
                own.append((i, b[k][0]))
                k += 1
        links.append(own)
    counts = Counter(p for own in links for p in own)
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    out = []
    for (doc_id, _), (a, b), own in zip(docs, found, links, strict=True):
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, at = [], 0
        text = []
        ia = ib = 0
        for c in cuts:
            x, y = [], []
            while ia < len(a) and a[ia][2] <= c:
                x.append(str(a[ia][0]))
                ia += 1
            while ib < len(b) and b[ib][2] <= c:
                y.append(str(b[ib][0]))
                ib += 1
            text.append(",".join(x) + "|" + ",".join(y))
        sha = hashlib.sha256(";".join(text).encode()).hexdigest() if a else ""
        out.append((doc_id, len(a), len(b), len(cuts), len(own), sum(counts[p] == top[p[1]] for p in own), sum(counts[p] for p in own), sha))
    return out


def frame(spark, docs):
    return spark.createDataFrame([(*d, 1, 2, "x", 3, "y") for d in docs], DOCS).repartition(3)


def check(found, docs):
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got, want = sorted(map(tuple, found.collect()), key=repr), sorted(expected(docs), key=repr)
    assert [x for x in zip(got, want, strict=True) if x[0] != x[1]] == []


def test_query(spark, tmp_path):
    frame(spark, rows()).write.parquet(str(tmp_path / "documents.parquet"))
    check(registry.queries()["op12_alignment"](spark, str(tmp_path)), rows())


@pytest.mark.parametrize("docs", [[], [(1, None), (2, "")], [(1, "one")]])
def test_few_rows(spark, docs):
    check(alignment.align(frame(spark, docs)), docs)


def test_slices_of_pairs_small_tables_and_small_blocks(spark, monkeypatch):
    """Several slices of pairs, a table of chunks that is emptied often, long chunks that are not kept."""
    docs = rows()[:60] + rows()[-3:]
    monkeypatch.setattr(alignment, "_HELD", 50)
    check(alignment.align(frame(spark, docs), slice_pairs=100), docs)


def test_chunks_are_exact_whatever_the_text():
    """One aligner over texts one by one: its tables and its forgetting do not change results."""
    own = alignment.Aligner(path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))
    docs = rows()
    want = {i: w for i, w in enumerate(expected(docs))}
    old = alignment.REMEMBERED, alignment.LONGEST
    alignment.REMEMBERED, alignment.LONGEST = 90, 8
    try:
        for k in range(0, len(docs), 7):
            found = own.block([t for _, t in docs[k : k + 7]])
            for j in range(len(found["sha"])):
                assert (found["n_a"][j], found["n_b"][j], found["n_groups"][j], found["n_links"][j]) == want[k + j][1:5]
                assert found["sha"][j] == want[k + j][7]
    finally:
        alignment.REMEMBERED, alignment.LONGEST = old
