"""Repeated byte strings against a dictionary of all of them."""

import random
import zlib

import numpy as np
import pytest

from tabwright.llm.suffix_dedup import rank_by_doubling, remove_repeats

DOCS = "doc_id long, text string, low string, n int"


def brute(rows, length):
    docs = sorted({(-(2**63) if i is None else i, zlib.crc32((t or "").encode()), (t or "").encode()) for i, t in rows})
    seen, out = {}, {}
    for i, tie, raw in docs:
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            w = raw[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            else:
                seen[w] = 1
        spans, at = [], 0
        while at < len(raw):
            if gone[at]:
                end = at
                while end < len(raw) and gone[end]:
                    end += 1
                spans.append((at, end))
                at = end
            else:
                at += 1
        out[i, raw] = (len(raw), spans, bytes(b for b, g in zip(raw, gone, strict=True) if not g))
    return out


def corpus(length):
    draw = random.Random(length)
    words = [("wörd" if i % 7 == 0 else "word") + str(i) for i in range(300)]
    say = lambda n: " ".join(draw.choices(words, k=n))
    common, line = say(60), say(14)
    rows = []
    for i in range(120):
        text = say(draw.randrange(0, 90))
        if i % 3 == 0:
            at = draw.randrange(len(text) + 1)
            text = text[:at] + common[draw.randrange(40) : len(common) - draw.randrange(40)] + text[at:]
        if i % 4 == 0:
            text += "\n" + line + "\n" + say(3)
        if i % 10 == 9 and rows:
            text = list(rows[draw.randrange(len(rows))][1])
            for _ in range(draw.randrange(4)):
                if text:
                    text[draw.randrange(len(text))] = "#"
            text = "".join(text)
        rows.append((i * 3, text))
    rows += [(900, "ab " * 500), (901, "x" * 700), (902, "x" * 300 + say(5) + "x" * 150), (903, None), (904, ""), (None, common), (None, "another " + common)]
    rows += [(905, common + say(2)), (905, common + say(2)), (906, line * 3), (906, line * 3), (907, "y" * (length - 1)), (908, "y" * length), (909, "y" * length)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("length", "crowd", "parts"), [(100, 512, 5), (100, 2, 9), (48, 3, 1)])
def test_against_all_strings(spark, length, crowd, parts):
    rows = corpus(length)
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS).repartition(parts)
    got = remove_repeats(frame, length, crowd=crowd).collect()
    want = brute(rows, length)
    expected = sorted((-(2**63) if i is None else i, *want[-(2**63) if i is None else i, (t or "").encode()]) for i, t in rows)
    assert sorted((-(2**63) if r.doc_id is None else r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.removed], bytes(r.kept)) for r in got) == expected


def test_empty_and_alike(spark):
    assert remove_repeats(spark.createDataFrame([], DOCS)).collect() == []
    got = remove_repeats(spark.createDataFrame([(1, "short", None, None), (2, "short", None, None), (3, None, None, None)], DOCS)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.removed, bytes(r.kept)) for r in got) == [(1, 5, [], b"short"), (2, 5, [], b"short"), (3, 0, [], b"")]


def test_long_lengths_of_strings_that_defeat_polynomial_names(spark):
    """A Thue-Morse string and its complement have equal polynomial hashes modulo any power of two."""
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    rows = [(1, one), (2, "x" + two), (3, "y" + one[:1500] + "z" + two[300:])]
    got = remove_repeats(spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS), length=1024).collect()
    want = brute(rows, 1024)
    assert sorted((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.removed], bytes(r.kept)) for r in got) == sorted((i, *want[i, t.encode()]) for i, t in rows)


@pytest.mark.parametrize("length", [8, 13, 40, 100])
def test_doubling_ranks_equal_strings_alike(length):
    draw = np.random.default_rng(length)
    data = np.frombuffer(bytes(draw.integers(97, 99, 400).tolist()) + b"ab" * 150 + b"c" * 130, np.uint8)
    starts = np.sort(draw.choice(len(data) - length + 1, 300, replace=False))
    alive, rank = rank_by_doubling(data, starts, length)
    strings = [data[s : s + length].tobytes() for s in starts]
    assert sorted(alive.tolist()) == [i for i, x in enumerate(strings) if strings.count(x) > 1]
    by_rank = {}
    for i, r in zip(alive.tolist(), rank.tolist(), strict=True):
        by_rank.setdefault(r, set()).add(strings[i])
    assert all(len(x) == 1 for x in by_rank.values()) and len(by_rank) == len({strings[i] for i in alive})
