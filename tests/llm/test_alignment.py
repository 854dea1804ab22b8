import random
from bisect import bisect_left
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from trastienda.llm import alignment


class Brute:
    """The contract by the libraries' own whole-text calls, one token after another."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        self.bytes_a = {k: bytes(letters[c] for c in t) for t, k in self.a.get_vocab().items() if not t.startswith("<|")}

    def bytes_b(self, k):
        return bytes([int(self.b.id_to_piece(k)[3:5], 16)]) if self.b.is_byte(k) else self.b.id_to_piece(k).replace("▁", " ").encode()

    def groups(self, text):
        """[([(id, end)], [(id, end)])]: the groups of a text; none if it has no tokens."""
        if not text:
            return []
        sides, whole = [], (" " + text).encode()
        for ids, of in ((self.a.encode(" " + text, add_special_tokens=False).ids, self.bytes_a.__getitem__), (self.b.encode(text), self.bytes_b)):
            parts = [of(k) for k in ids]
            if b"".join(parts) != whole:
                return []
            sides.append(list(zip(ids, np.cumsum([len(p) for p in parts]).tolist(), strict=True)))
        cuts = sorted({e for _, e in sides[0]} & {e for _, e in sides[1]})
        found = [([], []) for _ in cuts]
        for which, side in enumerate(sides):
            for k, e in side:
                found[bisect_left(cuts, e)][which].append((k, e))
        return found


@pytest.fixture(scope="module")
def whole():
    return Brute()


ODD_TEXTS = [
    "", "a", "a b", "hello world", "<|endoftext|> <s> </s> <unk>", " lead  two   three \n x \t y", "tail ", "  ", " ", "\n", "▁x ok", "ok ▁", "ü ö 漢字 😀\n\n\t x",
    " " * 70, "\x00a a", "a\xa0b c", "\x1c x \x85 y\x1c z", "it's they'll 've 's x", "a\n b", "ﬁ ① é é", "the the the the", "x" * 3000, "﻿begin   end", "1 2  3",
]


def row(groups):
    text = ";".join(",".join(str(k) for k, _ in a) + "|" + ",".join(str(k) for k, _ in b) for a, b in groups)
    return sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), text


def test_texts_in_stretches_are_as_whole_texts(whole, documents):
    texts = ODD_TEXTS + [t or "" for _, t, _, _ in documents if len(t or "") < 6000]
    random.Random(3).shuffle(texts)
    known = alignment.Stretches(alignment.tokenizer(alignment.LEFT), alignment.tokenizer(alignment.RIGHT))
    for step in range(0, len(texts), 50):
        part = texts[step : step + 50]
        for text, (counts, written, pair, times) in zip(part, known.of(part), strict=True):
            groups = whole.groups(text)
            assert (*counts, written) == row(groups), text
            linked = Counter(a[-1][0] << 32 | b[-1][0] for a, b in groups)
            assert dict(zip(pair.tolist(), times.tolist(), strict=True)) == linked


def test_forgetting_changes_nothing(monkeypatch, documents):
    texts = [t or "" for _, t, _, _ in documents[:60]]
    sides = alignment.tokenizer(alignment.LEFT), alignment.tokenizer(alignment.RIGHT)
    once = alignment.Stretches(*sides).of(texts)
    monkeypatch.setattr(alignment, "REMEMBERED", 300)
    small = alignment.Stretches(*sides)
    again = [x for text in texts for x in small.of([text])]
    assert [(a[0], a[1], a[2].tolist(), a[3].tolist()) for a in once] == [(a[0], a[1], a[2].tolist(), a[3].tolist()) for a in again]


def test_pointer_jumping_on_long_chains():
    """Tokens of two bytes on both sides, one byte apart: one chain through all of them."""
    n = 3000
    a, b = np.arange(2, 2 * n + 1, 2), np.concatenate([np.arange(1, 2 * n, 2), [2 * n]])
    last_a, last_b = alignment.groups(a, b)
    assert set(last_a.tolist()) == set(last_b.tolist()) == {n - 1}
    rng = random.Random(1)
    for _ in range(200):
        ends = [sorted({*rng.sample(range(1, 60), rng.randrange(1, 40)), 60}) for _ in range(2)]
        last_a, last_b = alignment.groups(*map(np.array, ends))
        cuts = sorted(set(ends[0]) & set(ends[1]))
        for side, last in zip(ends, (last_a, last_b), strict=True):
            assert [ends[0][k] for k in last] == [min(c for c in cuts if c >= e) for e in side]


def test_linked_pairs_are_bounded_by_the_vocabularies(documents):
    a, b = alignment.tokenizer(alignment.LEFT), alignment.tokenizer(alignment.RIGHT)
    texts = [t or "" for _, t, _, _ in documents[:100]]
    for _, _, pair, _ in alignment.Stretches(a, b).of(texts):
        for k in pair.tolist():
            x, y = a.bytes[k >> 32], b.bytes[k & 0xFFFFFFFF]
            assert x.endswith(y) or y.endswith(x)
    assert alignment.possible_pairs([b"a", b"ba", b"a"], [b"a", b"cba", b"x"]) == 3 + 3


def expected(whole, rows):
    found = [(d, whole.groups(t or "")) for d, t in rows]
    counts = Counter((a[-1][0], b[-1][0]) for _, groups in found for a, b in groups)
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for doc_id, groups in found:
        links = [counts[a[-1][0], b[-1][0]] for a, b in groups]
        best = sum(n == most[b[-1][0]] for n, (_, b) in zip(links, groups, strict=True))
        n_a, n_b, n_groups, text = row(groups)
        out.append((doc_id, n_a, n_b, n_groups, n_groups, best, sum(links), sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out)


def test_query_against_brute_force(spark, sf, documents, whole):
    from trastienda.llm.registry import QUERIES

    rows = QUERIES["op13_token_alignment"](spark, sf).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    assert sorted(map(tuple, rows)) == expected(whole, [(d, t) for d, t, _, _ in documents])


def test_odd_and_no_rows(spark, odd, nothing, odd_rows, whole):
    rows = alignment.alignment(odd).collect()
    assert len(rows) == len(odd_rows)
    assert all(r.n_a == r.count_sum == 0 and r.groups_sha256 == "" for r in rows if r.key in (3, 4))
    same = {r.groups_sha256 for r in rows if r.key in (1, 2)}
    assert len(same) == 1
    frame = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id long, text string")
    names = ("key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(map(tuple, alignment.alignment(frame).select(*names).collect())) == expected(whole, list(enumerate(ODD_TEXTS)))
    groups = alignment.aligned(frame, with_groups=True).where("key = 2").first().groups
    assert groups == "257|264;275|287"
    assert alignment.alignment(nothing).count() == 0
