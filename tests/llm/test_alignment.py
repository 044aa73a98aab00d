"""Cross-tokenizer alignment against a plain version that tokenizes whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowharbor.llm import alignment
from rowharbor.llm.packs import squeeze


def brute(rows, sides):
    tokens = []
    for _, text in rows:
        a = b = []
        if text:
            a = sides.a.encode(" " + text, add_special_tokens=False).ids
            b = sides.b.encode(text)
            whole = (" " + text).encode()
            if b"".join(sides.a_bytes[t] for t in a) != whole or b"".join(sides.b_bytes[t] for t in b) != whole:
                a = b = []
        tokens.append((a, b))
    links, groups = [], []
    for a, b in tokens:
        i = j = at_a = at_b = 0
        own, parts, ga, gb = [], [], [], []
        while i < len(a):
            own.append((a[i], b[j]))
            ga, gb = (ga if ga and ga[-1] == i else [*ga, i]), (gb if gb and gb[-1] == j else [*gb, j])
            end_a, end_b = at_a + len(sides.a_bytes[a[i]]), at_b + len(sides.b_bytes[b[j]])
            if end_a == end_b:
                parts.append(",".join(str(a[k]) for k in ga) + "|" + ",".join(str(b[k]) for k in gb))
                ga, gb = [], []
            if end_a <= end_b:
                i, at_a = i + 1, end_a
            if end_b <= end_a:
                j, at_b = j + 1, end_b
        links.append(own)
        groups.append(parts)
    count = Counter(p for own in links for p in own)
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return sorted(
        [(doc, len(a), len(b), len(g), len(own), sum(count[p] == top[p[1]] for p in own), sum(count[p] for p in own),
          hashlib.sha256(";".join(g).encode()).hexdigest() if own else "")
         for (doc, _), (a, b), own, g in zip(rows, tokens, links, groups, strict=True)], key=str)


ODD = [
    None, "", " ", "  ", "\n", " lead", "trail ", "two  blanks", "tab\tand \n line", "a▁b", "▁", "x" * 3000,
    "<|endoftext|> and <s> </s> <unk> <0x41> <0x0A>", "don't can't we've I'll", "Straße über Ångström",
    "\U0001F600\U0001F601 中文字 　  nbsp", "é combining ​ zero", "\x00 nul \x1c\x1d fs",
    "many    blanks     here", "\r\n\r\n crlf \x85 next", "1234567 12,345.67", "ภาษา", "a ▁ b c",
]


def test_matches_whole_text_tokenization(spark, documents, odd):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(900, ODD[13]), (900, ODD[13]), (None, "no id here")]
    rows += [(1000 + r[0], r[1]) for r in documents.select("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("pack", F.lit(1)).repartition(5)
    got = sorted(map(tuple, alignment.align(docs).collect()), key=str)
    assert got == brute(rows, alignment.Sides.load(alignment.FOLDER))
    assert alignment.align(odd).count() == odd.count()


def test_random_texts_split_as_whole(spark):
    rng = random.Random(5)
    signs = list("abcdeE ,.'▁é中\n\t") + [" "] * 8 + ["th", "ing", "'s", "  ", " "]
    rows = [(i, "".join(rng.choices(signs, k=rng.randrange(40)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, alignment.align(docs).collect()), key=str)
    assert got == brute(rows, alignment.Sides.load(alignment.FOLDER))


def test_long_texts_go_in_slices(spark, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE_CHARS", 50)
    for text in ("some words in a row " * 40, "x" * 500, "word " + "y" * 300 + " end  of it"):
        parts = [p for found in alignment.pieces(text) for p in found]
        assert " ".join(parts) == text


def test_empty_table(empty):
    assert alignment.align(empty).collect() == []


@pytest.mark.parametrize("n", [1, 3, 20])
def test_heap_merge_counts_pairs(n):
    rng = np.random.default_rng(n)
    expected, runs = Counter(), []
    for _ in range(n):
        pairs = np.unique(rng.integers(0, 500, rng.integers(1, 300)))
        counts = rng.integers(1, 9, len(pairs))
        expected.update(dict(zip(pairs.tolist(), counts.tolist(), strict=True)))
        runs.append([squeeze(np.concatenate((pairs[i:i + 16], counts[i:i + 16]))) for i in range(0, len(pairs), 16)])
    got = list(alignment.merged(runs))
    keys, counts = np.concatenate([k for k, _ in got]), np.concatenate([c for _, c in got])
    assert keys.tolist() == sorted(expected) and dict(zip(keys.tolist(), counts.tolist(), strict=True)) == expected
