"""Each text operator against brute force, on rows with nulls, copies, ties and clashing columns."""

import contextlib
import random
import re
import struct
import zlib

import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rillhouse.llm import (
    block_labeller,
    common,
    decontamination,
    jaccard_join,
    language_mixture,
    license_scan,
    sentencepiece,
    spot_signatures,
    substring_dedup,
    token_records,
    toxicity,
)

DOCS = "doc_id bigint, text string, lang string, score double, component_id int, e string, n_removed int"
BPE, SP = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def frame(spark, texts, lang="en"):
    """Documents numbered from 0, or `(doc_id, text)` rows, with columns of clashing names."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, lang, 9.0, 7, "x", 3) for i, t in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def prose(rng, n, words=None):
    return " ".join(rng.choice(words) if words else "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(n))


def odd_texts():
    return [None, "", "  \n\t ", "one", "the the the", "the " * 12_000, "é" * 5_000, "A\x00b c", "x y z w v"]


# ---- n-gram Jaccard join


def brute_components(rows):
    sets = {}
    for i, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = odd_texts()
    for size in (4, 5, 6, 9, 14, 40, 150):
        base = prose(rng, size).split()
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = prose(rng, 1)
            texts.append(" ".join(copy + prose(rng, rng.choice([0, 0, 1, 3])).split()))
    rows = list(enumerate(texts))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_components(frame(spark, texts)).collect()}
    assert found == brute_components(rows)


def test_wide_sketches_bound_the_distance_and_drop_unrelated_sets(spark):
    rng = random.Random(5)
    base = prose(rng, 1030).split()
    texts = [" ".join(base[: 1030 - n] + prose(rng, extra).split()) for n, extra in [(0, 0), (9, 4), (40, 0), (60, 90), (400, 300)]]
    texts += [prose(rng, 1500) for _ in range(6)]
    sets = jaccard_join.Sets(texts)
    rows = [(int(k), int(n), [int(x) for x in w]) for k, n, w in zip(sets.keys(), sets.sizes, sets.wide_sketches())]
    classes = spark.createDataFrame(rows, "key bigint, n_shingles bigint, wide array<bigint>")
    keys = [r[0] for r in rows]
    pairs = spark.createDataFrame([(a, b) for a in keys for b in keys if a < b], "a bigint, b bigint")
    left = {(r.a, r.b) for r in jaccard_join._likely(pairs, classes, jaccard_join.SIMILARITY).collect()}
    near = set()
    for i, a in enumerate(keys):
        for j, b in enumerate(keys):
            one, two = set(sets.of(i).tolist()), set(sets.of(j).tolist())
            if a < b and 5 * len(one & two) >= 4 * len(one | two):
                near.add((a, b))
    assert near and near <= left
    assert not [p for p in left if keys.index(p[0]) > 4 or keys.index(p[1]) > 4]


def test_long_unrelated_texts_with_one_passage_are_not_compared_whole(spark, monkeypatch):
    rng = random.Random(6)
    words = [prose(rng, 1) for _ in range(5_000)]
    passage = prose(rng, 120, words)
    texts = [prose(rng, 700, words) + " " + passage + " " + prose(rng, 700, words) for _ in range(120)]
    texts += [texts[0] + " once more", texts[0]]
    compared, likely = [], jaccard_join._likely
    monkeypatch.setattr(
        jaccard_join, "_likely", lambda *given: compared.append(likely(*given).count()) or likely(*given)
    )
    found = {r.doc_id: r.component_id for r in jaccard_join.near_components(frame(spark, texts)).collect()}
    assert found == {i: 0 if i >= 120 else i for i in range(122)}
    assert 1 <= sum(compared) <= 4


def test_a_passage_of_many_unrelated_texts_gives_no_pairs(spark, monkeypatch):
    rng = random.Random(7)
    words = [prose(rng, 1) for _ in range(5_000)]
    passage = prose(rng, 250, words)
    texts = [prose(rng, 700, words) + " " + passage + " " + prose(rng, 700, words) for _ in range(60)]
    texts += [texts[0] + " once more", " ".join(texts[1].split()[:-120]), "short " + passage, passage]
    met, likely = [], jaccard_join._likely
    monkeypatch.setattr(jaccard_join, "_likely", lambda *given: met.append(given[0].count()) or likely(*given))
    found = {r.doc_id: r.component_id for r in jaccard_join.near_components(frame(spark, texts)).collect()}
    assert found == {i: {60: 0, 61: 1, 63: 62}.get(i, i) for i in range(64)}
    # The 60 texts alone make 1,770 pairs.
    assert 3 <= sum(met) <= 20


def test_a_pair_of_near_copies_is_taken_once_however_many_signatures_it_shares(spark, monkeypatch):
    rng = random.Random(9)
    words = [prose(rng, 1) for _ in range(5_000)]
    base = prose(rng, 400, words).split()
    texts = [" ".join(base)]
    for _ in range(60):
        copy = list(base)
        for place in rng.sample(range(400), rng.randrange(6, 13)):
            copy[place] = prose(rng, 1, words)
        texts.append(" ".join(copy))
    taken, meetings = [], jaccard_join._meetings
    monkeypatch.setattr(
        jaccard_join, "_meetings",
        lambda *given: taken.extend((min(r), max(r)) for r in meetings(*given).collect()) or meetings(*given),
    )
    rows = list(enumerate(texts))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_components(frame(spark, texts)).collect()}
    assert found == brute_components(rows)
    # Without a rule each pair would come once for every signature that it shares.
    assert len(set(taken)) >= 20
    assert len(taken) <= 3 * len(set(taken))


def test_meetings_are_all_pairs_that_share_a_signature_of_either_band(spark):
    rng = random.Random(10)
    rows, component = [], {key: key if key % 3 else 3 for key in range(1, 31)}
    for key in component:
        for sig in rng.sample(range(60), rng.choice([1, 2, 8, 40])):
            # Below 30 the signatures are of the band of the even keys.
            rows.append((sig, key, (sig < 30) == (key % 2 == 0), component[key]))
    known = spark.createDataFrame(rows, "sig bigint, key bigint, own boolean, component bigint")
    left = jaccard_join._open(known).withColumns(
        {"n_shingles": F.lit(9), "sketch": F.array(*[F.lit(0).cast("bigint")] * jaccard_join.SKETCH)}
    )
    met = [(min(r), max(r)) for r in jaccard_join._meetings(left, jaccard_join.SIMILARITY).collect()]
    expected = {
        (a, b)
        for sig, a, own, _ in rows
        for other, b, its, _ in rows
        if sig == other and a < b and (own or its) and component[a] != component[b]
    }
    assert set(met) == expected
    shared = sum(
        sig == other and a < b and (own or its) and component[a] != component[b]
        for sig, a, own, _ in rows for other, b, its, _ in rows
    )
    assert len(met) < shared / 2


def test_needs_are_met_by_every_similar_pair():
    rng = random.Random(8)
    words = [prose(rng, 1) for _ in range(400)]
    texts = []
    for size in (5, 6, 8, 11, 20, 60, 300):
        for _ in range(12):
            whole = prose(rng, size, words).split()
            texts += [" ".join(whole), " ".join(whole[: -max(1, size // 8)]), " ".join(whole + whole[:2])]
    sets = jaccard_join.Sets(texts)
    sigs, owners, needs = jaccard_join.signatures(sets, jaccard_join.Bands())
    mine = [set(sigs[owners == i].tolist()) for i in range(len(texts))]
    need = {(int(o), int(s)): int(n) for o, s, n in zip(owners, sigs, needs)}
    similar = 0
    for i in range(len(texts)):
        for j in range(len(texts)):
            one, two = set(sets.of(i).tolist()), set(sets.of(j).tolist())
            if i != j and one != two and 5 * len(one & two) >= 4 * len(one | two):
                similar += 1
                # One of the two bands the sets have in common meets the needs of both.
                shared = mine[i] & mine[j]
                levels = {(need[i, s], need[j, s]) for s in shared}
                assert any(
                    sum((need[i, s], need[j, s]) == level for s in shared) >= max(map(abs, level)) for level in levels
                )
    assert similar > 50


def test_texts_reach_python_in_batches_bounded_in_bytes(spark, monkeypatch):
    docs = frame(spark, ["a b c d e f"])

    def step(*_):
        raise InterruptedError  # the bound is set before the first step

    for module in (jaccard_join, substring_dedup, decontamination, toxicity):
        monkeypatch.setattr(module, "stored", step)
    labels = spark.createDataFrame([(0, 1)], "doc_id bigint, toxic int")
    benchmark = spark.createDataFrame([(0, "a b c")], "item_id bigint, text string")
    for operator in (
        lambda: jaccard_join.near_components(docs),
        lambda: toxicity.training_rows(docs, labels),
        lambda: substring_dedup.without_repeats(docs),
        lambda: decontamination.contamination(docs, benchmark),
        lambda: sentencepiece.encode_documents(docs, SP),
    ):
        spark.conf.unset(common.BATCH)
        with contextlib.suppress(InterruptedError):
            operator()
        assert spark.conf.get(common.BATCH, None) == str(common.BATCH_BYTES)
    long = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("text"))
    sizes = long.mapInPandas(lambda frames: (pd.DataFrame({"n": [f["text"].str.len().sum()]}) for f in frames), "n bigint")
    sizes = [r["n"] for r in sizes.collect()]
    assert sum(sizes) == 400 * 20_000 and max(sizes) <= common.BATCH_BYTES + 20_000
    spark.conf.set(common.BATCH, "5m")
    common.small_batches(spark)
    assert spark.conf.get(common.BATCH, None) == "5m"
    spark.conf.unset(common.BATCH)


def test_discarded_steps_are_empty_and_no_row_of_them_comes_from_python(spark, monkeypatch):
    schema = "key bigint, items array<bigint>, e struct<a:int,b:string>"
    step = common.stored(spark.createDataFrame([(1, [2, 3], (4, "x"))], schema), "step")
    path = step.inputFiles()[0].rsplit("/", 1)[0]
    monkeypatch.setattr(type(spark), "createDataFrame", None)
    common.discard(step)
    assert spark.read.schema(step.schema).parquet(path).count() == 0


def test_wanted_sets_are_those_whose_bit_is_set():
    wanted = jaccard_join.np.zeros(4, jaccard_join.np.uint64)
    wanted[0], wanted[3] = 1, 1 << 63
    rows = pd.DataFrame({"bit": [0, 1, 255, 63, 64], "text": ["a", "b", "c", "d", "e"]})
    found = pd.concat(jaccard_join._wanted_sets(iter([rows]), 5, wanted))
    assert found["key"].tolist() == jaccard_join.Sets(["a", "c"]).keys().tolist()


def test_jaccard_without_ids_and_rows(spark):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (9, "A b c d e f")]
    found = sorted((str(r.doc_id), r.component_id) for r in jaccard_join.near_components(frame(spark, rows)).collect())
    assert found == [("3", 3), ("3", 3), ("9", 3), ("None", None)]
    assert jaccard_join.near_components(empty(spark)).count() == 0


# ---- substring dedup


def brute_passages(rows, length):
    """`(text, n_removed, [(start, length, first_doc)])` of every row, rows in order of `(doc_id, place)`."""
    seen, out = {}, {}
    for i, text in rows:
        spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text or "")]
        low = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text[a:b]) for a, b in spans]
        gone, source = set(), {}
        for k in range(len(low) - length + 1):
            first = seen.setdefault(tuple(low[k : k + length]), (i, k))
            if first != (i, k):
                gone.update(range(k, k + length))
                source.setdefault(k, first[0])
        passages, kept, at, k = [], "", 0, 0
        while k < len(spans):
            if k in gone:
                e = k
                while e in gone:
                    e += 1
                passages.append((spans[k][0], spans[e - 1][1] - spans[k][0], source[k]))
                kept, at, k = kept + text[at : spans[k][0]], spans[e - 1][1], e
            else:
                k += 1
        out[i] = (None if text is None else kept + text[at:], len(gone), passages)
    return out


@pytest.mark.parametrize("length", [5, 8, 51])
def test_passages_equal_brute_force(spark, length):
    rng = random.Random(length)
    passages = [prose(rng, n) for n in (length - 1, length, length + 1, 2 * length, 5 * length)]
    spaced = [re.sub(" ", lambda m: rng.choice([" ", "\n", "  ", "\t"]), p) for p in passages]
    texts = odd_texts()
    for k in range(60):
        parts = [prose(rng, rng.randint(0, 2 * length)), rng.choice(passages + spaced), prose(rng, rng.randint(0, 9)), rng.choice(passages).upper()]
        texts.append(rng.choice([" ", ", ", "\n"]).join(parts[: rng.randint(1, 4)]))
    texts += [texts[-1], texts[-1], passages[-1], passages[-1] + " " + passages[-1], "a b " * 3 * length]
    want = brute_passages(list(enumerate(texts)), length)
    docs = frame(spark, texts)
    found = {r.doc_id: (r.text, r.n_removed, [(p.start, p.length, p.first_doc) for p in r.passages]) for r in substring_dedup.without_repeats(docs, length).collect()}
    assert found == want
    assert any(len(p) > 1 for _, _, p in want.values()) and sum(bool(n) for _, n, _ in want.values()) > 20


def test_repeated_rows_null_ids_and_no_rows(spark):
    line = " ".join(f"w{i}" for i in range(60))
    rows = [(None, line), (1, line), (1, line), (1, "x " + line), (2, "short line"), (3, "short line")]
    docs = frame(spark, rows)
    found = substring_dedup.without_repeats(docs)
    assert sorted((str(r.doc_id), r.text, r.n_removed) for r in found.collect()) == [
        ("1", "", 60), ("1", "", 60), ("1", "x ", 60), ("2", "short line", 0), ("3", "short line", 0), ("None", line, 0)]
    assert found.columns == [c for c in docs.columns if c != "n_removed"] + ["n_words", "n_removed", "passages"]
    assert {p.first_doc for r in found.collect() for p in r.passages} == {None}
    assert substring_dedup.without_repeats(empty(spark)).count() == 0


def test_texts_of_many_lines(spark):
    rng = random.Random(2)
    lines = [prose(rng, 6) for _ in range(100_000)]
    texts = ["\n".join(lines), "\n".join(prose(rng, 6) for _ in range(50_000)) + "\n" + "\n".join(lines[500:])]
    found = substring_dedup.without_repeats(frame(spark, texts)).orderBy("doc_id").collect()
    assert found[0].text == texts[0] and found[1].n_removed == 6 * 99_500


# ---- decontamination


def brute_contamination(texts, items):
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    out = []
    for text in texts:
        w, hit, names = words(text), set(), set()
        for item, t in items:
            v = words(t)
            n = min(10, len(v))
            for k in range(len(v) - n + 1) if n and item is not None else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[k : k + n]:
                        hit |= set(range(p, p + n))
                        names.add(str(item))
        out.append((len(w), len(hit), sorted(names)))
    return out


def test_contamination_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [prose(rng, 1) for _ in range(40)]
    items = [(i, prose(rng, n, vocabulary)) for i, n in enumerate((25, 14, 10, 3, 1))] + [(10, ""), (11, None), (None, "q r"), (12, "aa " * 15), (0, "zz yy xx")]
    texts = odd_texts() + ["aa " * 40]
    for _ in range(40):
        item = rng.choice(items[:4])[1].split()
        a = rng.randrange(len(item))
        texts.append(", ".join([prose(rng, 15, vocabulary), " ".join(item[a:]).upper(), prose(rng, 5), " ".join(item)][rng.randint(0, 2) :]))
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, doc_id int")
    found = decontamination.contamination(frame(spark, texts), bench).orderBy("doc_id").collect()
    want = brute_contamination(texts, items)
    assert [(r.n_words, r.n_hit, r.n_items) for r in found] == [(n, h, len(names)) for n, h, names in want]
    import hashlib

    assert [r.items_sha256 for r in found] == [hashlib.sha256(",".join(names).encode()).hexdigest() for _, _, names in want]
    none = decontamination.contamination(frame(spark, ["a b"]), bench.where("false")).first()
    assert (none.n_hit, none.contaminated) == (0, False) and decontamination.contamination(empty(spark), bench).count() == 0


def test_proximity_matches(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id bigint, text string")
    texts = ["a b c d e f g h i j", "a b c x d e f g h i j", "a b c d e f g h i"]
    rows, near = decontamination.find_matches(frame(spark, texts), bench, slack=1)
    found = {r.doc_id: r.exact for r in rows.join(near.groupBy("row").agg({"exact": "max"}).withColumnRenamed("max(exact)", "exact"), "row").collect()}
    assert found == {0: True, 1: False}


# ---- toxicity


def test_segments_equal_brute_force():
    rng = random.Random(3)
    terms = {"bad": (9, 2.0), "worse": (9, 3.5), "fine": (9, -1.5)}
    scores = toxicity.Scores(terms)
    for _ in range(300):
        tokens = [rng.choice(["bad", "worse", "fine", "other", "other"]) for _ in range(rng.randint(0, 14))]
        values = [terms[t][1] if t in terms else -toxicity.DRIFT for t in tokens]
        want, todo = [], [(0, len(tokens))]
        while todo:  # the best segment, then the rest left and right of it
            a, b = todo.pop()
            best = max(((round(sum(values[i:j]), 9), -(j - i), -i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0, 0))
            if best[0] > 1e-9:
                i, j = -best[2], best[3]
                want.append((i, j))
                todo += [(a, i), (j, b)]
        got = toxicity.segments(scores, tokens)
        assert sorted(round(sum(values[a:b]), 6) for a, b, _ in got) == sorted(round(sum(values[a:b]), 6) for a, b in want)
        assert all(abs(s - sum(values[a:b])) < 1e-9 for a, b, s in got)


def toxic_table(spark, n=400):
    rng = random.Random(8)
    vocabulary = [prose(rng, 1) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randint(10, 60), vocabulary).split()
        if i % 4 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["zwoful", "zwofest", "grimm"]))
        rows.append((i, " ".join(words)))
        labels.append((i, i % 2, int(i % 4 == 0)))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_table(spark)
    found = toxicity.score_documents(docs, labels).where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    right = [(r.predicted == 1) == (r.doc_id % 4 == 0) for r in found]
    assert len(right) > 40 and sum(right) / len(right) > 0.95 and all(0 <= r.score <= 1 for r in found)
    odd = toxicity.score_documents(docs.unionAll(frame(spark, [(1000 + i, t) for i, t in enumerate(odd_texts())] + [(None, "x")])), labels)
    assert odd.where("score between 0 and 1").count() == 410 and odd.where("doc_id is null and held_out").count() == 1


def test_toxicity_without_labels(spark):
    docs, labels = toxic_table(spark, 8)
    assert toxicity.score_documents(docs, labels.where("false")).where("score between 0 and 1").count() == 8
    assert toxicity.score_documents(empty(spark), labels).count() == 0


# ---- language mixtures


def languages(spark, n=240):
    rng = random.Random(4)
    words = {k: ["".join(rng.choice(s) for _ in range(rng.randint(2, 7))) for _ in range(80)] for k, s in (("aa", "abcde"), ("bb", "vwxyz"), ("cc", "klmnoé"))}
    rows = [(i, prose(rng, 30, words[k]), k) for i, k in ((i, rng.choice(list(words))) for i in range(n))]
    df = spark.createDataFrame([(i, t, k, 1.0, 1, "x", 1) for i, t, k in rows], DOCS)
    return df, words


def test_languages_of_held_out_rows(spark):
    docs, words = languages(spark)
    found = language_mixture.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 50 and sum(r.lang == r.lang_pred for r in found) / len(found) > 0.97
    mixed = " ".join(words["aa"][:40] + words["bb"][:20])
    more = docs.unionAll(frame(spark, [(900, mixed), (901, None), (902, "123 !"), (None, "abc"), (903, mixed * 200), (904, "\u2764\ufe0f 1")], None))
    out = {r.doc_id: r for r in language_mixture.identify(more).where("doc_id >= 900 or doc_id is null").collect()}
    assert [x.lang for x in out[900].languages] == ["aa", "bb"] and abs(out[900].languages[0].share - 2 / 3) < 0.05
    assert (out[901].lang_pred, out[902].lang_pred, out[901].score, out[904].lang_pred) == ("und", "und", 0.0, "und") and out[None].held_out
    assert language_mixture.identify(docs.withColumn("lang", docs.e)).count() == 240
    assert language_mixture.identify(empty(spark)).count() == 0


def test_documents_of_many_languages(spark):
    docs, words = languages(spark)
    rng = random.Random(9)
    for k, letters in (("dd", "fghij"), ("ee", "pqrstu"), ("ff", "äöüßñ")):
        words[k] = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(80)]
        docs = docs.unionAll(frame(spark, [(1000 * ord(k[0]) + i, prose(rng, 30, words[k])) for i in range(80)], k))
    names, shares = sorted(words), {4: (4, 3, 2, 1), 5: (5, 4, 3, 2, 1), 6: (1, 1, 1, 1, 1, 1)}
    texts = [(-n, " ".join(" ".join(words[k][:80] * x) for k, x in zip(names, shares[n]))) for n in shares]
    more = docs.unionAll(frame(spark, texts, None))
    found = {r.doc_id: r.languages for r in language_mixture.identify(more).where("doc_id < 0").collect()}
    for n, parts in shares.items():
        assert {x.lang for x in found[-n]} == set(names[:n])
        assert all(abs(x.share - parts[names.index(x.lang)] / sum(parts)) < 0.03 for x in found[-n])


# ---- token records


def test_records_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    rng = random.Random(6)
    texts = odd_texts() + ["a  b", " lead", "tail ", "a \n b", "it's  we'll, no.\n\nNext\tx", "<|endoftext|> x", "a <|endoftext|>", " ", "  ", " a", "a\x1cb \x1fc \x85d", "x \u2028 y", "<|endoftext", "a　 b", "a  b"]
    texts += ["".join(rng.choice("ab '.,1 \n\té") for _ in range(60)) for _ in range(150)]
    found = token_records.token_records(frame(spark, texts), BPE).orderBy("doc_id").collect()
    at = 0
    for row, text in zip(found, texts, strict=True):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert (row.start, row.n_tokens, row.ids_crc32) == (at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))), text
        at += len(ids)
    assert token_records.token_records(empty(spark), BPE).count() == 0


def test_records_of_one_id_and_of_none_are_spread(spark, folder):
    rng = random.Random(3)
    rows = [(rng.choice([5, 5, 5, None, None, rng.randrange(10)]), prose(rng, 3)) for _ in range(400)]
    manifest = token_records.write_records(frame(spark, rows), f"{folder}/t", BPE).orderBy("shard").collect()
    assert len(manifest) > 5 and sum(m.records for m in manifest) == 400
    ids = [i for m in manifest for i, _ in token_records.read_shard(m.path)]
    assert ids == sorted((i for i, _ in rows), key=lambda i: -1 if i is None else i)
    found = token_records.token_records(frame(spark, rows), BPE).orderBy("start").collect()
    assert [r.doc_id for r in found] == ids and found[-1].start + found[-1].n_tokens == sum(r.n_tokens for r in found)


def test_records_by_offset_and_damage(spark, folder):
    manifest = token_records.write_records(frame(spark, [(None, "x"), (4, "a b"), (4, "a b"), (9, None)]), f"{folder}/t", BPE).collect()
    assert sum(m.records for m in manifest) == 4
    assert [i for m in sorted(manifest) for i, _ in token_records.read_shard(m.path)] == [None, 4, 4, 9]
    shard = max(manifest)
    whole = list(token_records.read_shard(shard.path))
    assert [(i, ids.tolist()) for i, ids in (token_records.read_record(shard.path, i) for i in range(len(whole)))] == [(i, ids.tolist()) for i, ids in whole]
    assert (whole[-1][0], whole[-1][1].tolist()) == (9, [2])
    with open(f"{shard.path}.bin", "r+b") as f:
        f.seek(14)
        f.write(b"\xff")
    with pytest.raises(ValueError):
        list(token_records.read_shard(shard.path))


# ---- SentencePiece


def test_ids_equal_the_library(spark):
    import sentencepiece as library

    model = library.SentencePieceProcessor(model_file=SP)
    rng = random.Random(2)
    texts = odd_texts() + ["Hello  world\n a", " lead", "한국 <s> </s>", "a\r\nb", "x" * 2_000]
    texts += ["".join(rng.choice("thaneiorsd  .,\né한") for _ in range(80)) for _ in range(200)]
    found = sentencepiece.encode_documents(frame(spark, texts), SP).orderBy("doc_id").collect()
    assert [list(r.ids) for r in found] == [model.encode(t or "") for t in texts]
    assert [r.decoded for r in found] == [t or "" for t in texts]
    assert sentencepiece.encode_documents(empty(spark), SP).count() == 0


@pytest.mark.parametrize("letters", ["abcdeinorst", "aeé", "▁the", "xq漢"])
def test_paths_equal_merging(letters):
    pieces, rng = sentencepiece.read_pieces(SP), random.Random(8)
    for _ in range(2000):
        word = "▁" + "".join(rng.choice(letters) for _ in range(rng.randint(1, 24)))
        assert sentencepiece.best_path(pieces, word) == sentencepiece.merged(pieces, word)


def test_relational_lattice_and_fold(spark):
    table = spark.createDataFrame([("a", 0), ("b", 1), ("ab", 2), ("ba", 3), ("aba", 4)], "piece string, id int")
    scores = [-2.0, -2.0, -1.0, -3.0, -9.0]
    words = spark.createDataFrame([("abab",), ("aba",), ("b",), ("axb",)], "word string")
    lattices = sentencepiece.relational_lattice(words, table, 3)
    found = {r.word: list(r.ids) for r in sentencepiece.best_paths(lattices, scores).collect()}
    assert found == {"abab": [2, 2], "aba": [2, 0], "b": [1], "axb": [0, -1, 1]}
    docs = spark.createDataFrame([("a b a",), (None,), ("",)], "text string")
    assert {r.word for r in sentencepiece.word_table(docs).collect()} == {"▁a", "▁b"}


# ---- licences


def test_licences_equal_brute_force(spark):
    texts = odd_texts() + [
        "Released under the MIT License", "mit license mit license", "CC BY", "x\nLicensed under CC BY-NC 4.0.\ny",
        "under the license released MIT", "GNU General\nPublic License", "the mit", "license apache",
    ]
    found = license_scan.scan_documents(frame(spark, texts)).orderBy("doc_id").collect()
    for row, text in zip(found, texts, strict=True):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(i, label) for p, label in license_scan.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        base = sorted({label for _, label in places})
        assert (row.n_words, row.n_base, row.base_labels) == (len(w), len(places), ",".join(base))
        assert (row.first_word, row.last_word) == (min((p for p, _ in places), default=None), max((p for p, _ in places), default=None))
        want = set(base)
        for label, template in license_scan.TEMPLATES:
            need = set(template.split())
            for line in (low or "").split("\n"):
                have = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line))
                if len(have & need) >= license_scan.CONTAINMENT * len(need):
                    want.add(label)
        assert row.labels == ",".join(sorted(want)) and 0 <= row.score <= 1
    assert license_scan.scan_documents(empty(spark)).count() == 0


def test_licences_of_windows_equal_brute_force(spark):
    mit = "# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated files"
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted"
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General\nPublic License"
    rng = random.Random(6)
    spread = prose(rng, 400).split()
    for k, word in enumerate(license_scan.TEMPLATES[6][1].split()):
        spread[20 * k] = word
    released = "Released under the MIT License\n"
    texts = [mit, bsd, gpl, " ".join(spread), prose(rng, 3000) + " " + mit.replace("\n", " ") + " " + prose(rng, 50), released * 2]
    words = " ".join(t for _, t in license_scan.TEMPLATES).split()
    for _ in range(80):
        w = rng.choice(license_scan.TEMPLATES)[1].split()
        for _ in range(rng.choice([0, 1, 3, 8])):
            w.insert(rng.randrange(len(w)), rng.choice(words))
        del w[: rng.choice([0, 0, 1, 2])]
        w = prose(rng, rng.choice([0, 30]), words).split() + w + prose(rng, rng.choice([0, 300])).split()
        texts.append("".join(x + rng.choice([" ", " ", " ", "\n"]) for x in w))
    found = license_scan.scan_documents(frame(spark, texts)).orderBy("doc_id").collect()
    for row, text in zip(found, texts, strict=True):
        w, want, most = re.findall("[a-z0-9]+", text.lower()), set(filter(None, row.base_labels.split(","))), 0.0
        for label, template in license_scan.TEMPLATES:
            need = set(template.split())
            share = max(len(need & set(w[i : i + len(template.split()) * 3 // 2])) for i in range(len(w))) / len(need)
            if share >= license_scan.CONTAINMENT:
                want.add(label)
                most = max(most, share)
        assert row.labels == ",".join(sorted(want)) and max((b.containment for b in row.blocks), default=0.0) == most
        assert row.score == (1.0 if row.n_base else most)
    assert [found[i].labels for i in (0, 1, 3, 4)] == ["mit-notice", "bsd-notice", "", "mit-notice"] and "gpl-notice" in found[2].labels
    assert [(b.line, b.label, b.containment) for b in found[5].blocks] == [(0, "mit-notice", 1.0), (1, "mit-notice", 1.0)]
    assert (found[0].blocks[0].line, found[4].blocks[0].containment) == (0, 1.0)


# ---- spot signatures


def test_edited_fingerprints(spark):
    import hashlib

    rng = random.Random(9)
    vocabulary = ["the", "of", "and", "le", *(prose(rng, 1) for _ in range(60))]
    texts = [t for t in odd_texts()] + [prose(rng, rng.randint(1, 80), vocabulary) for _ in range(60)]
    rows = [(i * 3 - 40, t) for i, t in enumerate(texts)]
    found = spot_signatures.edited_fingerprints(frame(spark, rows + [(None, "gone")])).orderBy("doc_id").collect()
    prints = {}
    for at, (row, text) in enumerate(zip(found, texts, strict=True)):
        text, after = text or "", texts[(at + 1) % len(texts)] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        prints[text] = row.fingerprint
        if edited in prints:
            assert prints[edited] == row.edited_fingerprint
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    sets = [{r.fingerprint[k : k + 8] for k in range(0, len(r.fingerprint), 8)} for r in found]
    for at, row in enumerate(found):
        a, b = sets[at], sets[(at + 1) % len(sets)]
        assert row.near_next == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    assert spot_signatures.edited_fingerprints(empty(spark)).count() == 0


def test_near_pairs_equal_brute_force(spark):
    rng = random.Random(1)
    sets = []
    for _ in range(12):
        base = rng.sample(range(500), rng.randint(1, 30))
        for _ in range(6):
            sets.append(sorted(set(base) - set(rng.sample(base, min(len(base) - 1, rng.randint(0, 3)))) | set(rng.sample(range(500, 520), rng.randint(0, 2)))))
    prints = spark.createDataFrame(list(enumerate(sets)) + [(999, [])], "key bigint, signatures array<int>")
    found = {tuple(sorted((r.a, r.b))) for r in spot_signatures.near_pairs(prints).collect()}
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if 10 * len(set(sets[i]) & set(sets[j])) >= 8 * len(set(sets[i]) | set(sets[j]))}
    assert found == want and want


# ---- pages


def test_pages(spark):
    page = (
        '<!DOCTYPE html><html><head><title>T</title><script>var t="</p><p>no";</script></head><body>'
        '<nav><ul><li><a href="/x">Home</a></li><li><a href="/y">News</a></li></ul></nav><!-- ad <p>no</p> -->'
        '<div class="ad">Buy now and save.</div><article><h1>A title &amp; more</h1>'
        "<p><b>Lomo   panite\n kilo.<br><p>Second &lt;b&gt; bit of it, rane mole.<p>Third one, tane <i>lo</i>pe.</article>"
        "<div class=comments><p>Bob says: Great post</p></div><footer>&copy; example.com</footer></body></html>"
    )
    rows = [(1, "u", page, "x", 1), (2, None, None, "x", 1), (3, "v", "", "x", 1), (None, "w", "<p", "x", 1), (5, "z", "<div>" * 3000 + "word", "x", 1), (5, "z", "plain", "x", 1)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int")
    found = block_labeller.extract_pages(df).collect()
    text = {r.url: r.text for r in found}
    assert text["u"] == "A title & more\n\nLomo panite kilo.\n\nSecond <b> bit of it, rane mole.\n\nThird one, tane lope."
    assert len(found) == 6 and text[None] == "" and text["v"] == "" and all(r.n_chars == len(r.text) for r in found)


def test_every_word_of_a_block_is_seen():
    words = [f"w{i % 7}" for i in range(200)]
    plain = block_labeller.vectors([(" ".join(words), ("p",), 0)])
    other = next(w for w in ("x", "y", "z") if all(block_labeller.slot(w, block_labeller.WORD_SIZE) != block_labeller.slot(v, block_labeller.WORD_SIZE) for v in set(words)))
    for at in range(1, 199):
        changed = block_labeller.vectors([(" ".join([*words[:at], other, *words[at + 1 :]]), ("p",), 0)])
        assert (changed != plain).any(), at


def test_labeller_on_unseen_pages():
    network, rng = block_labeller.train(), random.Random(1234)
    wrong = total = 0
    for _ in range(150):
        page, main = block_labeller.generated_page(rng)
        found = block_labeller.blocks(page)
        p = block_labeller.scores(network, [block_labeller.vectors(found)])[0]
        wrong += sum((b[0] in main) != (s >= 0.5) for b, s in zip(found, p))
        total += len(found)
    assert wrong / total < 0.03


# ---- pipeline


def test_pipeline_stages(spark, folder):
    import corpus_pipeline

    docs, labels = toxic_table(spark, 200)
    docs = docs.selectExpr("doc_id", "text", "lang", "'s' AS source", "cast(length(text) AS bigint) AS n_chars", "1 AS more")
    line = " ".join(f"w{i}" for i in range(60))
    leak = "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10 q11"
    own = " ".join(f"v{i}" for i in range(25))
    extra = [(500, f"{line}\n{own}"), (501, f"another\n{line}"), (502, f"so {leak} on"), (503, "p " * 30), (504, "p " * 30), (505, None)]
    docs = docs.unionAll(spark.createDataFrame([(i, t, "en", "s", 1, 1) for i, t in extra], docs.schema))
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert [i in found for i in (500, 501, 502, 503, 504, 505)] == [True, True, False, True, False, True]
    assert found[501].decoded == "another\n" and found[500].decoded == extra[0][1]
    kept = [i for i in found if i < 200]
    assert sum(i % 4 == 0 for i in kept) <= 2 and sum(i % 4 != 0 for i in kept) >= 148


def test_pipeline_drops_rows_not_ids(spark, folder):
    import corpus_pipeline

    def stage(f, rows):
        docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
        return sorted(((r.doc_id, r.text) for r in f(spark, docs, folder).collect()), key=str)

    copy, own, other = ("".join(f" {c}{i}" for i in range(30)) for c in "abc")
    rows = [(3, copy), (3, own), (2, copy + " more"), (2, copy), (7, other), (7, other), (None, copy), (9, None), (9, None)]
    found = stage(corpus_pipeline.drop_near_copies, rows)
    assert [i for i, _ in found] == [2, 3, 7, 9, 9, None] and (3, own) in found and (None, copy) in found
    leak = " ".join(f"q{i}" for i in range(12))
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [(1, leak), (1, own), (None, leak), (None, own), (2, None)]
    assert stage(corpus_pipeline.drop_contaminated, rows) == sorted([(1, own), (None, own), (2, None)], key=str)
