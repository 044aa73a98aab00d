"""Inputs on which the operators once did less than the whole job."""

import numpy as np

from rowharbor.llm import decontaminate, ordermin, units


def slow_score(doc, item):
    """Smith-Waterman cell by cell."""
    above, best = [0.0] * (len(doc) + 1), 0.0
    for word in item:
        row = [0.0]
        for j, other in enumerate(doc):
            row.append(max(0.0, above[j] + (1.0 if word == other else -0.5), above[j + 1] - 0.5, row[j] - 0.5))
        best, above = max(best, *row), row
    return best


def test_all_copies_at_the_threshold_are_found(spark):
    """Every 4th, 5th and 6th word changed, words added between all others, short items; exact copies beside them."""
    rng = np.random.default_rng(5)
    items = [[f"w{w}" for w in rng.integers(0, 400, n)] for n in (1, 2, 3, 4, 5, 9, 14, 20, 33, 50)]
    pad, texts = ["pad"] * 7, []
    for item in items:
        texts += [pad + item + pad] * 2
        for step in (4, 5, 6):
            texts.append(pad + [f"x{i}" if i % step == step - 1 else w for i, w in enumerate(item)] + pad)
        for added in range(2, 6):  # a word is added after this many fifths of all words
            texts.append(pad + [x for i, w in enumerate(item) for x in ([w, "and"] if i % 5 < added else [w])] + pad)
        for _ in range(15):
            texts.append(pad + [x for w in item for x in ([w], [w], [w], [], ["or", w], ["no"])[rng.integers(0, 6)]] + pad)
    want = {(d, k) for d, text in enumerate(texts) for k, item in enumerate(items) if slow_score(text, item) >= 0.6 * len(item)}
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()} == want


def test_edits_of_texts_without_blanks_and_of_few_words(spark):
    rng = np.random.default_rng(7)

    def run(low, high, n=2000):
        return "".join(map(chr, rng.integers(low, high, n)))

    def changed(text, at):
        return text[:at] + "Q" + text[at + 1:]

    long = [run(0x4E00, 0x9000), run(0xE01, 0xE2F), run(97, 123), run(0x20000, 0x20200)]
    words = [run(97, 123, 6) for _ in range(64 + 1)]
    pairs = [(t, changed(t, at)) for t in long for at in (0, 700, 1999)]  # one letter of 2,000
    pairs += [(t, t[:1500] + run(0x3041, 0x3091, 500)) for t in long]  # three quarters are the same
    pairs += [(t, changed(t, 7)) for t in ("three short words", "supercalifragilistic", "one, two and three fours")]
    pairs += [(" ".join(words[:n]), " ".join(words[:n + 1])) for n in (7, 15, 64 - 1, 64)]  # no length parts them
    pairs += [(a, b) for a, b in zip(long, long[1:], strict=False)]
    docs = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    near = ordermin.likeness(ordermin.sketch(docs["a"]), ordermin.sketch(docs["b"]))
    got = [r[0] for r in docs.orderBy("i").select(near).collect()]
    assert min(got[:12]) > 0.9 and min(got[12:16]) > 0.3 and min(got[16:19]) > 0.1 and min(got[19:23]) > 0.5
    assert max(got[23:]) < 0.1


def test_removals_are_reported_by_text(spark):
    line = "a b c d e"
    texts = [(1, line), (None, f"x\n{line}"), (None, f"one more\n{line}"), (2, f"y\n{line}"), (2, f"yyy\n{line}")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = [(r["doc_id"] or 0, r["n_units"], r["spans"]) for r in units.removal_report(docs, units.repeated_units(docs)).collect()]
    assert sorted(got) == [(0, 1, "2:11"), (0, 1, "9:18"), (1, 0, ""), (2, 1, "2:11"), (2, 1, "4:13")]
