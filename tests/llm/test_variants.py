"""Spelling variants against a plain version that removes each letter in turn."""

import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from rowharbor.llm import variants


def plain_words(rows, least=7):
    import re

    total = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= least:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= 2}


def plain_groups(words):
    holes = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1:], "letter"].add(w)
        for i in range(len(w) + 1):
            holes[w[:i], w[i:], "gap"].add(w)
    near = defaultdict(set)
    for (before, behind, kind), own in holes.items():
        if kind == "letter":
            for w in own:
                near[w] |= own - {w}
                for other in holes.get((before, behind, "gap"), ()):
                    near[w].add(other)
                    near[other].add(w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] >= 10 * n:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=str)


def found(docs):
    return sorted(map(tuple, variants.group_variants(docs).collect()), key=str)


def test_documents_match_plain_version(spark, documents, odd):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = found(documents)
    assert got == plain_groups(plain_words(rows)) and any(r[1] for r in got)
    rows = [(r[0], r[1]) for r in odd.select("doc_id", "text").collect()]
    assert found(odd) == plain_groups(plain_words(rows))


def test_crowded_vocabulary(spark):
    """Few letters and few stems: frequent grams everywhere, edits at both ends, chains of forms."""
    rng = random.Random(3)
    words = set()
    for stem in ("banana", "nationale", "aaaaaaa", "ßöäüéaaa", "abababab"):
        for _ in range(400):
            w = stem + "".join(rng.choices("abn", k=rng.randrange(1, 4)))
            for _ in range(rng.randrange(3)):
                i = rng.randrange(len(w))
                w = w[:i] + rng.choice(["", "a", "z"]) + w[i + rng.randrange(2):]
            words.add(w)
    rows = [(i, " ".join(rng.choices(sorted(words), k=30) + ["bananaa"] * rng.randrange(9))) for i in range(400)]
    rows += [(None, "Bananaa BANANAA bananaá"), (None, None), (7, ""), (7, "nationalea " * 3), (7, "nationalea " * 3)]
    rows += [(10_000 + i, "chained1 " + "chainedx " * 2 + "chainedxx " * 25 + "chainedxxx " * 300) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    got = found(docs)
    assert got == plain_groups(plain_words(rows))
    assert any(r[1] and r[1] != r[2] for r in got)


def test_long_texts_go_in_slices(monkeypatch):
    monkeypatch.setattr(variants, "SLICE", 10)
    text = "one Two threeÀ " * 9 + "x" * 100 + " end"
    assert [w for part in variants.runs(text) for w in part] == variants.RUN.findall(text.translate(variants.LOWER))


def test_empty_table(empty):
    assert found(empty) == []
