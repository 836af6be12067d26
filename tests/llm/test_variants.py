"""Fill-in-middle forms, spelling variants and near vectors against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rillhouse.llm import fill_in_middle, pruned_graph, spelling_variants

DOCS = "doc_id bigint, text string, n bigint, word string, form string, h1 int, whole string"


def frame(spark, texts):
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, 7, "w", "psm", 3, "y") for i, t in rows], DOCS)


def odd_texts():
    return [None, "", "  \n\t ", "one", "the the the", "the " * 12_000, "é" * 5_000, "A\x00b c", "𝒳y z—w\nv", "a" * 50_000]


# ---- fill in middle


def brute_form(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", text, None, None
    if h4 % 100 < 20:
        return n, "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return n, "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


def test_forms_equal_brute_force(spark):
    rng = random.Random(1)
    texts = odd_texts() + ["<P>", "a <S> b", "x<M", "<", "<<<", "P>S>M>", "$1 \\E {2}+ (x)", "<S<P<M a b c < < <S"]
    texts += ["".join(rng.choice("ab<PSM> \n$\\é𝒳") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    rows = list(enumerate(texts)) + [(None, "a b c"), (7, "one two"), (7, "one two")]
    docs = frame(spark, rows)
    want = Counter((i, *brute_form(i, t)) for i, t in rows)
    done = fill_in_middle.fill_in_middle(docs)
    assert Counter((r.doc_id, r.n, r.form, r.output, r.prefix_chars, r.middle_chars) for r in done.collect()) == want
    assert {r.form for r in done.collect()} == {"plain", "psm", "spm"}
    sums = fill_in_middle.digests(docs).collect()
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert Counter((r.doc_id, r.output_sha256) for r in sums) == Counter((w[0], digest(w[3])) for w in want.elements())
    assert Counter((r.doc_id, r.restored_sha256) for r in sums) == Counter((i, digest(t)) for i, t in rows)
    assert fill_in_middle.digests(frame(spark, [])).count() == 0


def test_very_long_text_is_cut(spark):
    text = "a b" * 700_000 + "\n"
    (row,) = fill_in_middle.fill_in_middle(frame(spark, [(4, text)])).collect()
    assert (row.n, row.form, row.output, row.prefix_chars, row.middle_chars) == brute_form(4, text)


# ---- spelling variants


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def are_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words):
    near = {w: [v for v in words if are_near(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= 2 * words[w]}
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    letters = "aaabÀÉé"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 8))) for _ in range(30)]
    base += ["aaaaa", "aaaaaa", "aaaaaaa", "abababab", "x" * 70, "x" * 71, "x" * 40 + "y" + "x" * 30, "ñ" * 300, "ñ" * 299 + "n"]
    words = list(base)
    for w in base:
        for _ in range(rng.randint(1, 6)):
            i, c = rng.randrange(len(w)), rng.choice(letters)
            words += [w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :], w[:i] + c + w[i:]]
    chain = ["kettung", "kettunge", "kettunges", "kettungess"]
    rows = [(i, " ".join(rng.choices(words, k=40))) for i in range(60)]
    rows += [(100 + i, " ".join(w.upper() if i % 3 else w for j, w in enumerate(chain) for _ in range(3 * 2**j))) for i in range(4)]
    rows += [(None, "hello hello hello × ÷ naïve"), (5, "twice told twice told twice told"), (5, "twice told twice told twice told")]
    rows += list(enumerate(odd_texts()))
    found = spelling_variants.variants(frame(spark, rows))
    got = [tuple(r) for r in found.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    want = brute_variants(brute_words(rows))
    assert len(got) == len(set(got)) and set(got) == want
    assert any(w[1] and w[1] != w[2] for w in want)


def test_near_words_and_no_words(spark):
    words = spark.createDataFrame([(w, 3) for w in ("aabb", "abb", "aabbb", "acbb", "zzzz")], "word string, n bigint")
    found = {(r.word, r.near) for r in spelling_variants.near_words(words).collect()}
    all_words = [r.word for r in words.collect()]
    assert found == {(a, b) for a in all_words for b in all_words if are_near(a, b)}
    assert spelling_variants.near_words(words).count() == len(found)
    assert spelling_variants.variants(frame(spark, [])).count() == 0
    assert spelling_variants.variants(frame(spark, [None, "", "a b"])).count() == 0


# ---- near vectors


VECTORS = "vec_id bigint, embedding array<double>, v int, node bigint, shard string"


def brute_links(rows):
    def fit(v):
        return v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v or ())

    unit = {k: np.array(v, float) / np.abs(v).max() for k, (_, v) in enumerate(rows) if fit(v)}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
    near = {a: [b for b in unit if a != b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95] for a in unit}
    return near


def components_of(rows, near):
    name, out = {}, {}
    for a in range(len(rows)):
        if a in name:
            continue
        name[a], todo = a, [a]
        while todo:
            for b in near.get(todo.pop(), []):
                if b not in name:
                    name[b] = a
                    todo.append(b)
    for top in set(name.values()):
        ids = [rows[k][0] for k in name if name[k] == top and rows[k][0] is not None]
        out |= {k: min(ids, default=None) for k in name if name[k] == top}
    return out


def vectors(rng, n, d=24):
    """Random vectors, loose and tight groups, chains of near neighbours, and copies."""
    out = [rng.normal(size=d) for _ in range(n)]
    for size, noise in ((60, 0.01), (40, 0.2), (25, 0.25)):
        centre = rng.normal(size=d)
        out += [centre * rng.uniform(0.1, 9) + noise * np.linalg.norm(centre) / np.sqrt(d) * rng.normal(size=d) for _ in range(size)]
    a, b = rng.normal(size=(2, d))
    out += [np.cos(t) * a / np.linalg.norm(a) + np.sin(t) * b / np.linalg.norm(b) for t in np.linspace(0, 1.2, 9)]
    return [list(map(float, v)) for v in out] + [list(map(float, out[0]))] * 30


@pytest.mark.parametrize("size", [2048, 64])
def test_links_equal_brute_force(spark, size):
    rng = np.random.default_rng(3)
    rows = list(enumerate(vectors(rng, 300)))
    rows += [(9000, None), (9001, []), (9002, [0.0] * 24), (9003, [1.0, None]), (9004, [float("nan")] * 24), (9005, [1.0, float("inf")])]
    rows += [(None, rows[0][1]), (3, rows[3][1]), (9006, [1.0, 2.0]), (9007, [2.0, 4.0]), (9008, [1e-200] * 24), (9009, [1e200] * 24)]
    order = rng.permutation(len(rows))
    df = spark.createDataFrame([(rows[k][0], rows[k][1], 1, 2, "x") for k in order], VECTORS)
    near = brute_links(rows)
    nodes = pruned_graph.distinct_vectors(df)
    got, exact = pruned_graph.audit(nodes, pruned_graph.links(nodes, size=size), queries=10_000)
    assert exact and got >= 0.9 * exact
    found = pruned_graph.near_vectors(df, size=size).collect()
    named = components_of(rows, near)
    want = Counter((i, len(near.get(k, [])), named[k], i is not None and i == named[k]) for k, (i, _) in enumerate(rows))
    have = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in found)
    assert len(found) == len(rows)
    if size == 2048:  # one shard, and the search misses nothing here
        assert have == want
    assert sum((have & want).values()) >= 0.9 * len(rows)
    links = {}
    for i, n, _, _ in want.elements():
        links.setdefault(i, []).append(n)
    assert all(r.n_links <= max(links[r.vec_id]) for r in found)


def test_no_vectors(spark):
    assert pruned_graph.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0
    none = pruned_graph.near_vectors(spark.createDataFrame([(4, None, 1, 2, "x")], VECTORS)).collect()
    assert [tuple(r) for r in none] == [(4, 0, 4, True)]


def test_a_dense_group_is_cut_into_blocks(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=16)
    rows = [(i, list(map(float, centre + 0.001 * rng.normal(size=16)))) for i in range(400)]
    df = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], VECTORS)
    found = pruned_graph.near_vectors(df, size=64).collect()
    assert {(r.n_links, r.component_id, r.kept) for r in found} == {(399, 0, True), (399, 0, False)}
