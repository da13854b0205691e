"""Alignment against the two tokenizer libraries and a comparison of all tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import token_align as A

FIRST, SECOND = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
EDGES = [None, "", " ", "  ", "\n", "a", "a▁b", "<|endoftext|> <s> </s> <unk> <0x41>", "x\ty\r\n  z ", " nbsp　wide", "é́ \U0001f469‍\U0001f4bb", "\x00\x01 \x7f",
         "ﬁ ½ ①", "Don't 123 4567!!  ...", "日本語のテキスト مرحبا", "aaaa" * 900, " " * 3000 + "end", "=" * 5000, "ab " * 2000]


@pytest.fixture(scope="module")
def files(spark):
    return A.read_file(spark, FIRST), A.read_file(spark, SECOND)


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    letters = A.byte_letters()
    spelt = lambda k: bytes(letters[x] for x in first.id_to_token(k))

    def piece(k):
        p = second.id_to_piece(k)
        return bytes([int(p[3:5], 16)]) if second.is_byte(k) else p.replace("▁", " ").encode()

    def tokens(text):
        """Spans (id, begin, end) of both sides, or nothing."""
        sides = []
        for ids, of in ((first.encode(" " + text, add_special_tokens=False).ids, spelt), (second.encode(text), piece)):
            spans, at, data = [], 0, b""
            for k in ids:
                data += of(k)
                spans.append((k, at, len(data)))
                at = len(data)
            if data != b" " + text.encode():
                return [], []
            sides.append(spans)
        return sides if text else ([], [])

    return tokens


def brute(rows, tokens):
    docs, count = [], Counter()
    for i, t in rows:
        a, b = tokens(t) if t else ([], [])
        links = [(x, y) for x, s, e in a for y, f, g in b if s < g and f < e] if len(a) < 400 else quick_links(a, b)
        count.update(links)
        both = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, at = [], 0
        for cut in both:
            groups.append(",".join(str(k) for k, s, e in a if at < e <= cut) + "|" + ",".join(str(k) for k, s, e in b if at < e <= cut))
            at = cut
        docs.append((i, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    high = defaultdict(int)
    for (_, y), n in count.items():
        high[y] = max(high[y], n)
    return Counter((i, na, nb, g, len(links), sum(count[x] == high[x[1]] for x in links), sum(count[x] for x in links), h) for i, na, nb, g, links, h in docs)


def quick_links(a, b):
    out, j = [], 0
    for x, s, e in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            out.append((x, b[k][0]))
            k += 1
    return out


@pytest.mark.parametrize("chunk_bytes", [8 << 20, 2000])
def test_documents_match_the_libraries(frame, words, files, libraries, chunk_bytes):
    rows = [(i, t) for i, t in words if t is None or len(t) < 3000] + [(900 + k, t) for k, t in enumerate(EDGES)] + [(None, "Don't 123"), (900, "a")]
    got = A.align_tokens(frame(rows).repartition(3), *files, chunk_bytes=chunk_bytes).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, libraries)


def test_walk_over_random_ends():
    rnd = random.Random(9)
    for _ in range(300):
        n = rnd.randint(1, 60)
        left = sorted({n, *(k for k in range(1, n) if rnd.random() < 0.7)})
        right = sorted({n, *(k for k in left if rnd.random() < 0.9), *(k for k in range(1, n) if rnd.random() < 0.1)})
        i, j, closes = A.align(left, right)
        span = lambda ends: list(zip([0, *ends], ends, strict=False))
        want = [(x, y, e == g) for x, (s, e) in enumerate(span(left)) for y, (f, g) in enumerate(span(right)) if s < g and f < e]
        assert [(int(x), int(y), bool(c)) for x, y, c in zip(i, j, closes, strict=True)] == sorted(want)


def test_long_diagonals_are_jumped():
    class Counted(list):
        looks = 0

        def __getitem__(self, k):
            Counted.looks += 1
            return super().__getitem__(k)

    ends = [*range(1, 100_001)]
    assert len(A.align(Counted(ends), Counted(ends))[0]) == 100_000 and Counted.looks < 100


def test_a_long_text_without_breaks_takes_no_square_time(frame, files):
    rows = [(1, "x" * 2_000_000), (2, "ab" * 500_000)]
    got = {r["doc_id"]: r for r in A.align_tokens(frame(rows), *files).collect()}
    assert all(r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] and r["n_a"] > 0 for r in got.values())


def test_empty_table(frame, files):
    assert A.align_tokens(frame([(1, "a")]).limit(0), *files).collect() == []
