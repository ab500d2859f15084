"""Benchmark decontamination and line templates."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from starmart.llm import decontaminate, templates
from starmart.llm.components import components
from starmart.llm.decontaminate import best_run, clean_documents, find_leaks, words_of
from starmart.llm.templates import drop_template_lines
from tests.llm import corpus


def brute(docs, items, least=13, share=0.75):
    """(doc, item) pairs with an overlap on some diagonal, all diagonals tried."""
    out = set()
    for doc_id, text in docs:
        w = np.array(words_of(text), dtype=object)
        for item_id, wanted in items:
            v = np.array(words_of(wanted), dtype=object)
            for d in range(-len(v), len(w)) if len(v) >= 5 else ():
                low, high = max(0, -d), min(len(v), len(w) - d)
                if high > low:
                    _, _, n = best_run(w[low + d : high + d] == v[low:high], share)
                    if n >= min(least, int(np.ceil(share * len(v)))):
                        out.add((doc_id, item_id))
    return out


def test_substitutions_are_tolerated_and_clean_texts_left(spark, monkeypatch):
    rng = random.Random(11)
    items = [(i, corpus.words(rng, n)) for i, n in enumerate([6, 9, 15, 30, 60, 3, 40])] + [(7, None), (8, ""), (None, "a b c d e f")]
    docs = []
    for _, text in items[:7]:
        for step in (0, 5, 7):
            w = text.split()
            for k in range(4, len(w), step) if step else ():
                w[k] = "swapped"
            docs.append(f"{corpus.words(rng, 30)} {' '.join(w).upper()}, {corpus.words(rng, 30)}")
    docs += [items[4][1], items[4][1][:90], corpus.words(rng, 3000) + items[3][1], None, ""] + [corpus.words(rng, 80) for _ in range(30)]
    rows = list(enumerate(docs)) + [(0, docs[0]), (None, docs[12])]
    df = spark.createDataFrame([(*r, "r", "h") for r in rows], "doc_id long, text string, row string, hash string")
    bench = spark.createDataFrame([(*r, "w") for r in items], "item_id long, text string, words string")
    wanted = brute([r for r in rows if r[1]], [i for i in items if i[0] is not None])
    for bound in (2_000_000, 60):
        monkeypatch.setattr(decontaminate, "PLACES_AT_ONCE", bound)
        got = {(r["doc_id"], r["item_id"]) for r in find_leaks(df, bench).collect()}
        assert got == wanted
    bad = {d for d, _ in wanted}
    kept = clean_documents(df, bench)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _ in rows if i not in bad)


def overlaps_of(words, wanted, least=13, share=0.75):
    """The definition itself: every stretch of every diagonal. Most equal words, then fewest words, then first; or None."""
    best = None
    for d in range(1 - len(wanted), len(words)):
        low, high = max(0, -d), min(len(wanted), len(words) - d)
        for i in range(low, high):
            n = 0
            for j in range(i, high):
                n += words[j + d] == wanted[j]
                if n >= share * (j + 1 - i) and n >= min(least, share * len(wanted)):
                    best = max(best or (0, 0, 0), (n, i - j - 1, -(i + d)))
    return best and (-best[2], -best[1], best[0])


def changed(pattern, names):
    return [w if c == "M" else "swapped" for c, w in zip(pattern, names, strict=True)]


def test_every_qualifying_stretch_is_a_leak(spark):
    rng = random.Random(5)
    patterns = ["MMMMMMxxMMMxMMMxMMMM", "MMMMMMMxxMMMMMMxxMMMMM", "MMMMMMxxxxMMMxxMMMxM"]
    patterns += ["".join(rng.choices("Mx", (5, 1), k=rng.randint(14, 40))) for _ in range(60)]
    items = [(i, [f"w{i}x{k}" for k in range(len(p))]) for i, p in enumerate(patterns)]
    docs = [(i, ["aside"] * rng.randint(0, 9) + changed(p, items[i][1]) + ["after"] * rng.randint(0, 9)) for i, p in enumerate(patterns)]
    wanted = {(i, i, *made) for i, words in docs if (made := overlaps_of(words, items[i][1]))}
    assert any(r[0] == 0 for r in wanted) and len(wanted) < len(docs)
    df, bench = (spark.createDataFrame([(i, " ".join(w)) for i, w in x], f"{n} long, text string") for x, n in ((docs, "doc_id"), (items, "item_id")))
    got = {tuple(r) for r in find_leaks(df, bench).drop("row").collect()}
    assert got == wanted


def most_without_seed(masks, n):
    """Most equal words among n with no mask met at any place, over all places of the misses."""
    span = max(m[-1] for m in masks) + 1
    shapes = [(m[-1] + 1, sum(1 << (m[-1] - k) for k in m)) for m in masks]
    best = {0: 0}
    for at in range(1, n + 1):
        step = {}
        for tail, count in best.items():
            for bit in (0, 1):
                new = (tail << 1 | bit) & ((1 << span) - 1)
                if not any(at >= width and new & shape == shape for width, shape in shapes):
                    step[new] = max(step.get(new, 0), count + bit)
        best = step
    return max(best.values())


def test_every_overlap_has_a_seed(spark):
    for size in range(5, 34):
        masks = decontaminate.MASKS[: decontaminate.masks_for(size)]
        need = min(13, int(np.ceil(0.75 * size)))
        for n in range(need, size + 1):
            assert most_without_seed(masks, n) < max(need, 0.75 * n), (size, n)
    patterns = ["MMMMM", "MMxMM", "xMMMM", "MxMMMM", "MMMxxMMM", "MMMx" * 5, "MMMx" * 15]
    items = [(i, [f"w{i}x{k}" for k in range(len(p))]) for i, p in enumerate(patterns)]
    docs = [(i, ["aside", *changed(p, items[i][1])]) for i, p in enumerate(patterns)]
    df, bench = (spark.createDataFrame([(i, " ".join(w)) for i, w in x], f"{n} long, text string") for x, n in ((docs, "doc_id"), (items, "item_id")))
    got = {tuple(r) for r in find_leaks(df, bench).drop("row").collect()}
    assert got == {(i, i, *overlaps_of(words, items[i][1])) for i, words in docs}


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    docs = corpus.documents(spark)
    assert find_leaks(corpus.empty(spark), bench).count() == 0
    assert find_leaks(docs, bench.limit(0)).count() == 0
    assert clean_documents(docs, bench.limit(0)).count() == docs.count()


def brute_lines(keyed, evidence=60, several=5):
    """doc_id, text, lines, dropped by the rule itself. keyed: doc_id, text, key of the text."""
    texts = {key: [templates.tokens_of(x) for x in (text or "").split("\n")] for _, text, key in keyed}
    held, nodes, values = defaultdict(set), defaultdict(set), defaultdict(set)
    for key, lines in texts.items():
        for t in filter(None, lines):
            node = (len(t), *t[:2])
            held[tuple(t)].add(key)
            nodes[node].add(key)
            for i, x in enumerate(t):
                values[node, i, x].add(key)

    def template(t):
        node = (len(t), *t[:2])
        shown = [x if x != "<*>" and (i < 2 or len(values[node, i, x]) >= several) else None for i, x in enumerate(t)]
        opened = any(x is None and y != "<*>" for x, y in zip(shown, t, strict=True))
        return tuple(shown) if len(nodes[node]) >= several and opened and 3 * shown.count(None) <= len(t) else None

    general = defaultdict(set)
    for t, keys in held.items():
        if template(list(t)):
            general[template(list(t))] |= keys

    def goes(t, key):
        own, wide = held[tuple(t)], general.get(template(t), set())
        fixed = len(t) - t.count("<*>")
        if len(own) >= 2 and len(own) * fixed >= evidence and key != min(own):
            return True
        return len(wide) >= several and len(wide) * sum(x is not None for x in template(t) or ()) >= evidence and key != min(wide)

    out = Counter()
    for doc_id, text, key in keyed:
        lines = (text or "").split("\n")
        kept = [x for x, t in zip(lines, texts[key], strict=True) if not t or not goes(t, key)]
        out[doc_id, None if text is None else "\n".join(kept), sum(map(bool, texts[key])), len(lines) - len(kept)] += 1
    return out


def dropped(docs, **options):
    keyed = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64("text")).collect()]
    got = Counter(map(tuple, drop_template_lines(docs.repartition(3), **options).collect()))
    assert got == brute_lines(keyed, **options)
    return {(r[0], r[1]): r[3] for r in got}


def test_recurring_templates_stay_in_one_text(spark):
    rng = random.Random(1)
    names = [corpus.words(rng, 1) for _ in range(40)]
    rows = []
    for i in range(40):
        lines = [corpus.words(rng, 12), f"user u{i} logged in at 12:{i}", corpus.words(rng, 3)]
        if i % 2:
            lines.insert(1, "copyright notice of the site")
        if i < 12:
            lines.append(f"session opened for {names[i]} by admin")
        if i < 20:
            lines.append(f"posted by {names[i]} on the board")
        if i < 9:
            lines.append(f"the quick {names[i]} fox jumps over {names[-i]} lazy dogs today")
        rows.append((i, "\n".join(lines), "leaf"))
    rows += [(100, None, "x"), (101, "", "x"), (102, "\n \n", "x"), (None, "copyright notice of the site", "x"), (5, rows[5][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, leaf string")
    found = dropped(docs)
    left = Counter(x.split()[0] for _, text in found for x in (text or "").split("\n") if x.startswith(("user", "copyright", "session", "posted", "the quick")))
    assert left == {"user": 1, "copyright": 1, "session": 1, "posted": 1, "the": 1}
    assert drop_template_lines(corpus.empty(spark)).count() == 0


def test_copies_lose_nothing(spark):
    """Ten equal texts are one; a text whose lines others copy keeps them all or has them kept elsewhere."""
    rng = random.Random(4)
    text = "\n".join(corpus.words(rng, 30) for _ in range(3))
    same = spark.createDataFrame([(i, text) for i in range(10)], "doc_id long, text string")
    assert dropped(same) == {(i, text): 0 for i in range(10)}
    near = [(i, f"{text}\n{corpus.words(rng, 9)}") for i in range(12)]
    found = dropped(spark.createDataFrame(near, "doc_id long, text string"))
    for line in text.split("\n"):
        assert sum(line in t.split("\n") for _, t in found) == 1


def test_random_lines_against_the_rule(spark):
    rng = random.Random(6)
    rows = []
    for i in range(80):
        lines = []
        for _ in range(rng.randint(0, 12)):
            n = rng.choice((2, 4, 6, 9))
            lines.append(" ".join([rng.choice("ab"), rng.choice("xy"), *(rng.choice(["p", "p", "q", "7", f"w{rng.choice('abcdefgh')}"]) for _ in range(n))][:n]))
        rows.append((i, rng.choice(["\n", " \n"]).join(lines)))
    docs = spark.createDataFrame([*rows, *rows[:9]], "doc_id long, text string")
    for options in ({"evidence": 25, "several": 5}, {"evidence": 12, "several": 3}):
        assert sum(dropped(docs, **options).values()) > 20


def test_repeated_passages_stay_once(spark):
    rng = random.Random(8)
    passages = [corpus.words(rng, n) for n in (25, 50, 60, 200)]
    rows = [(i, "\n".join([corpus.words(rng, 12), *passages[: 1 + i], corpus.words(rng, 60)])) for i in range(4)]
    rows += [(4, rows[3][1]), (5, passages[3] + " "), (6, passages[2].replace(" ", " 7 ", 1)), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = dropped(docs)
    text = {i: (t or "").split("\n") for i, t in found}
    assert text[3] == text[4] and text[6] == rows[6][1].split("\n")
    for p, holders in zip(passages, ([0, 1, 2, 3], [1, 2, 3], [2, 3], [3, 5]), strict=True):
        left = {text[i][0] for i in holders if p in [x.strip() for x in text[i]]}
        assert len(left) == 1


def test_no_text_is_emptied_whose_lines_stand_nowhere_else(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = dropped(docs)
    held = defaultdict(set)
    given = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for text in given.values():
        for line in text.split("\n"):
            held[tuple(templates.tokens_of(line))].add(text)
    emptied = [i for (i, text), n in found.items() if n and not (text or "").strip()]
    assert sum(found.values()) > 100
    for i in emptied:
        assert all(len(held[t]) > 1 for x in given[i].split("\n") if (t := tuple(templates.tokens_of(x))))
    # Some text still has each line of the emptied ones.
    left = {tuple(templates.tokens_of(x)) for _, text in found for x in (text or "").split("\n")}
    assert all(tuple(templates.tokens_of(x)) in left for i in emptied for x in given[i].split("\n"))


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (9, 9), (None, 1), (7, 8), (8, 3), (8, 3)] + [(100 + i, 101 + i) for i in range(40)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {**{i: 1 for i in (1, 2, 3, 7, 8)}, 4: 4, 5: 4, **{100 + i: 100 for i in range(41)}}
    assert components(df.limit(0)).count() == 0
