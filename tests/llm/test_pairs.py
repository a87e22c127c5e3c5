"""Near-duplicates, passages, benchmark items and components against brute force."""

from __future__ import annotations

import random

import numpy as np
from conftest import edited, odd_documents, prose

from starmart.llm import decontaminate, minhash, passages
from starmart.llm.components import component_labels
from starmart.llm.queries import substring_dedup
from starmart.llm.text import words_of
from starmart.staging import Staging


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")


def _classes(docs):
    members, links = minhash.near_duplicates(docs)
    return {r["id"]: r["class_id"] for r in members.collect()}, links


def test_near_copies_share_a_class_and_others_do_not(spark):
    texts = [prose(i, 200) for i in range(20)]
    texts += [edited(texts[0], 60), edited(texts[0], 50), texts[1], edited(texts[2], 5)]
    found, links = _classes(_docs(spark, texts))
    assert found[20] == found[21] == found[0] == 0
    assert found[22] == 1
    assert found[23] == 23
    assert all(found[i] == i for i in range(20))
    assert all(r["sim"] >= minhash.SIMILARITY for r in links.collect())


def test_classes_equal_brute_force_over_all_pairs(spark):
    rng = random.Random(7)
    texts = []
    for i in range(12):
        base = prose(100 + i, rng.randint(60, 300))
        texts += [base] + [edited(base, rng.choice((25, 40, 70, 100))) for _ in range(5)]
    docs = _docs(spark, texts)
    counts, total = minhash.word_frequencies(docs, "text")
    idf = minhash.inverse_frequencies(counts, total)
    sets = [minhash.weighted_shingles(words_of([t])[0], idf) for t in texts]
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if minhash.weighted_jaccard(sets[a], sets[b]) >= minhash.SIMILARITY:
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    found, _ = _classes(docs)
    assert [found[i] for i in range(len(texts))] == label


def test_a_large_group_of_near_copies_is_one_class(spark):
    base = prose(5, 150)
    copies = [edited(base, 150 - i % 60) + f" tail{i}" for i in range(150)]
    found, links = _classes(_docs(spark, [base, *copies, prose(6, 150)]))
    assert {found[i] for i in range(151)} == {0}
    assert found[151] == 151
    # Far fewer links than pairs.
    assert links.count() < 151 * 20


def test_samples_agree_as_often_as_texts_are_similar():
    base = prose(9, 400)
    idf = np.full(minhash.WORD_BUCKETS, 1.5, np.float32)
    sets = [
        minhash.weighted_shingles(words_of([t])[0], idf) for t in (base, edited(base, 40), base)
    ]
    starts = np.cumsum([0] + [len(s[0]) for s in sets[:-1]])
    joined = map(np.concatenate, zip(*sets, strict=True))
    samples = minhash.samples_of(*joined, starts, minhash._draws(minhash.BANDS * minhash.ROWS, 1))
    bands, samples = minhash.band_hashes(samples), samples.T
    assert (bands[0] == bands[2]).all()
    assert 0 < (bands[0] == bands[1]).sum() < minhash.BANDS
    assert 0.6 < (samples[0] == samples[1]).mean() < 1


def test_odd_rows_of_near_duplicates(odd_docs, no_docs):
    members, _ = minhash.near_duplicates(odd_docs)
    rows = members.collect()
    assert len(rows) == len(odd_documents())
    by_id = {r["id"]: r for r in rows}
    assert by_id[2]["class_id"] == 1
    assert by_id[3]["class_id"] == 3 and by_id[4]["class_id"] == 4
    assert sum(r["id"] is None for r in rows) == 2
    kept = minhash.one_of_each(odd_docs, members, "doc_id", "text")
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 8]
    empty, links = minhash.near_duplicates(no_docs)
    assert empty.count() == links.count() == 0


def test_components_are_the_smallest_labels(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    edges += [(i, i + 1) for i in range(300, 360)]
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    found = component_labels(spark.createDataFrame(edges, "a BIGINT, b BIGINT"), Staging(spark))
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert {r["node"]: r["label"] for r in found.collect()} == {n: label[n] for n in linked}


def test_repeated_passages_are_found_and_others_left_alone(spark):
    shared, fuzzy = prose(50, 70), prose(51, 90)
    texts = [
        prose(1, 100) + " " + shared + " " + prose(2, 60),
        prose(3, 30) + " " + shared,
        shared.upper() + " " + prose(4, 400),
        prose(5, 50) + " " + fuzzy + " " + prose(6, 50),
        edited(fuzzy, 12) + " " + prose(7, 50),
        prose(8, 300),
        " ".join(prose(9, 300).split()[:20] + prose(8, 300).split()[50:75]),  # too short
    ]
    found = passages.repeated_passages(_docs(spark, texts)).collect()
    assert {r["id"] for r in found} | {r["other_id"] for r in found} == {0, 1, 2, 3, 4}
    for r in found:
        a = texts[r["id"]].lower().split()[r["start"] : r["stop"]]
        b = texts[r["other_id"]].lower().split()[r["other_start"] : r["other_stop"]]
        assert min(len(a), len(b)) >= passages.LEAST_WORDS
        if r["equal"] == 1:
            assert a == b
        assert r["equal"] >= passages.LEAST_EQUAL


def test_a_passage_that_many_share_gives_a_row_each(spark):
    shared = prose(50, 60)
    texts = [prose(200 + i, 40) + " " + shared + " " + prose(400 + i, 40) for i in range(80)]
    found = passages.repeated_passages(_docs(spark, texts)).collect()
    assert {r["id"] for r in found} | {r["other_id"] for r in found} == set(range(80))
    assert len(found) < 5 * 80


def _altered(rng, words, edits):
    """As many random words replaced, left out or put in."""
    out = list(words)
    for i in sorted(rng.sample(range(len(words)), edits), reverse=True):
        kind = rng.random()
        if kind < 0.7:
            out[i] = f"new{rng.randrange(10**6)}"
        elif kind < 0.85:
            del out[i]
        else:
            out.insert(i, f"new{rng.randrange(10**6)}")
    return out


def _common(a, b):
    """Longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def test_passages_with_edits_are_found(spark):
    """Of planted pairs with up to a fifth of unequal words, by brute force, all but
    a few are found, and where they were planted."""
    rng = random.Random(11)
    words = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    texts, planted = [], []
    for _ in range(150):
        passage = words(rng.choice((50, 60, 80, 120)))
        copy = _altered(rng, passage, rng.randint(0, len(passage) // 5))
        before, after = words(rng.randint(0, 60)), words(rng.randint(0, 60))
        if _common(passage, copy) >= 0.8 * max(len(passage), len(copy)):
            planted.append((len(texts), len(before), len(passage)))
        texts += [" ".join(before + passage + words(30)), " ".join(words(25) + copy + after)]
    rows = passages.repeated_passages(_docs(spark, texts)).collect()
    met = {}
    for r in rows:
        assert r["id"] // 2 == r["other_id"] // 2, "no other texts share a passage"
        side = ("start", "stop") if r["id"] % 2 == 0 else ("other_start", "other_stop")
        met[min(r["id"], r["other_id"])] = (r[side[0]], r[side[1]])
    hits = [i for i, start, n in planted if i in met and met[i][0] < start + n and met[i][1] > start]
    assert len(planted) > 120 and len(hits) >= 0.95 * len(planted)


def test_quoters_do_not_hide_a_longer_passage(spark):
    """Two texts share 60 words; twelve others quote 24 of them, from any place."""
    texts = []
    for case in range(10):
        shared = prose(500 + case, 60).split()
        rng = random.Random(case)
        group = [prose(1000 + 20 * case + i, 50).split() for i in range(14)]
        for i, text in enumerate(group):
            at = rng.randint(0, 36)
            text[25:25] = shared if i < 2 else shared[at : at + 24]
        rng.shuffle(group)
        texts += [" ".join(t) for t in group]
    rows = passages.repeated_passages(_docs(spark, texts)).collect()
    assert {r["id"] // 14 for r in rows} == set(range(10))
    assert all(r["id"] // 14 == r["other_id"] // 14 and r["stop"] - r["start"] >= 55 for r in rows)


def test_many_quoters_do_not_hide_a_longer_passage(spark):
    """Two texts share 60 words; two hundred others quote 30 of them, from any place."""
    rng = random.Random(3)
    words = lambda n: [f"w{rng.randrange(30000)}" for _ in range(n)]
    texts = []
    for case in range(10):
        shared = words(60)
        for i in range(202):
            at = rng.randint(0, 30)
            text = words(50)
            text[25:25] = shared if i < 2 else shared[at : at + 30]
            texts.append((case, text))
    rng.shuffle(texts)
    rows = passages.repeated_passages(_docs(spark, [" ".join(t) for _, t in texts])).collect()
    assert {texts[r["id"]][0] for r in rows} == set(range(10))
    assert all(texts[r["id"]][0] == texts[r["other_id"]][0] and r["stop"] - r["start"] >= 55 for r in rows)


def test_occurrences_are_compared_with_all_of_their_seed(spark):
    """Two texts of forty agree most, in whatever parts they meet; the others agree
    with each of them as well."""
    rows = []
    for seed, parts in ((1, 1), (2, 4)):
        for i in range(40):
            mask = (1 << 20) - 1 if i in (7, 31) else (1 << 9) - 1
            rows.append((seed, i, 10 * seed, mask, 0, parts))
    seeds = spark.createDataFrame(rows, f"{passages.SEED}, parts INT")
    links = {tuple(r) for r in passages._linked(seeds, Staging(spark)).distinct().collect()}
    assert {(31, 7, 10, 10), (31, 7, 20, 20)} <= links
    assert {x for link in links for x in link[:2]} == set(range(40)) and len(links) < 2 * 3 * 40


def test_every_occurrence_of_a_passage_is_found(spark):
    """One text of a pair holds the passage twice or more often."""
    texts = []
    for case in range(20):
        shared = prose(700 + case, 50)
        times = 2 + case % 3
        many = " ".join(f"{shared} {prose(800 + 10 * case + i, 15)}" for i in range(times))
        texts += [many, prose(1200 + case, 20) + " " + shared]
    rows = passages.repeated_passages(_docs(spark, texts)).collect()
    for case in range(20):
        spans = {
            (r["start"], r["stop"]) if r["id"] == 2 * case else (r["other_start"], r["other_stop"])
            for r in rows if 2 * case in (r["id"], r["other_id"])
        }
        for i in range(2 + case % 3):
            assert any(a <= 65 * i + 5 and b >= 65 * i + 45 for a, b in spans), (case, i, spans)


def test_a_few_words_over_and_over_are_a_passage(spark):
    """Two texts each share a stretch of one to eight words that repeat at once."""
    texts = []
    for case in range(40):
        words = [f"w{case}x{i}" for i in range(1 + case % 8)]
        for side in range(2):
            begin, rest = prose(1500 + 2 * case + side, 10 + side), prose(1600 + 2 * case + side, 20)
            at = side % len(words)  # the other one begins within the words
            texts.append(" ".join([begin, *(words * 80)[at : at + 60 + 9 * side], rest]))
    rows = passages.repeated_passages(_docs(spark, texts)).collect()
    assert {r["id"] // 2 for r in rows} == set(range(40))
    assert all(r["id"] // 2 == r["other_id"] // 2 for r in rows)
    for r in rows:
        a = texts[r["id"]].lower().split()[r["start"] : r["stop"]]
        b = texts[r["other_id"]].lower().split()[r["other_start"] : r["other_stop"]]
        assert len(a) >= passages.LEAST_WORDS and (r["equal"] < 1 or a == b)
    long = {r["id"] // 2 for r in rows if r["stop"] - r["start"] >= 50}
    assert long == set(range(40))


def test_seeds_of_words_that_repeat_are_few_but_some():
    for size in range(1, 9):
        for case in range(20):
            words, first = words_of([" ".join([f"v{case}x{i}" for i in range(size)] * (1600 // size))])
            seeds, owner, place = passages.seeds_of(words, first)
            assert 7 <= len(place) <= 7 + 2 * size
            far = place[-7:] - passages.RUN_STEP * 2 ** np.arange(7)
            assert (far >= 0).all() and (far < 2 * size).all()
            # Far from its ends, wherever the seed lies, the surroundings look the same.
            masks = passages.masks_of(words, first, owner, place)
            inner = (place >= 40) & (place < 1540)
            for mask in masks:
                agree = np.bitwise_count(mask[inner] & mask[inner][0])
                assert agree.min() >= passages.LEAST_COMMON


def test_both_documents_of_a_passage_have_a_row(spark, tmp_path):
    shared = prose(50, 60)
    texts = [prose(2000 + i, 40) + " " + shared + " " + prose(2100 + i, 40) for i in range(12)]
    texts += [prose(2200, 80)] * 3 + [prose(2201, 80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = substring_dedup(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in rows} == set(range(15))
    found = {tuple(r) for r in rows}
    assert found == {(b, a, u, v, s, e, equal) for a, b, s, e, u, v, equal in found}
    for r in rows:
        a, b = (texts[r[x]].lower().split() for x in ("doc_id", "other_doc_id"))
        assert a[r["start"] : r["stop"]] == b[r["other_start"] : r["other_stop"]] or r["equal"] < 1


def test_copies_have_a_row_each_and_one_stands_for_them(spark):
    shared, copy = prose(50, 60), prose(51, 80)
    texts = [copy] * 30 + [prose(2, 40) + " " + shared, shared + " " + prose(3, 40)] + ["too short"] * 4
    rows = passages.repeated_passages(_docs(spark, texts)).collect()
    copies = [r for r in rows if r["id"] < 30]
    assert sorted(r["id"] for r in copies) == list(range(1, 30))
    assert {(r["other_id"], r["start"], r["stop"], r["equal"]) for r in copies} == {(0, 0, 80, 1.0)}
    assert [{r["id"], r["other_id"]} for r in rows if r["id"] >= 30] == [{30, 31}]


def test_a_hot_seed_meets_in_parts(spark, monkeypatch):
    """In parts of a few occurrences each text has its row as well."""
    shared = prose(50, 60)
    texts = [prose(200 + i, 20) + " " + shared + " " + prose(400 + i, 20) for i in range(60)]
    monkeypatch.setattr(passages, "SAMPLED", 1)
    monkeypatch.setattr(passages, "LEAST_HOT", 8)
    docs = _docs(spark, texts)
    hot = passages._hot(docs.selectExpr("xxhash64(text) AS key", "text")).collect()
    assert len(hot) >= 5 and all(2 <= r["parts"] <= 8 for r in hot)
    rows = passages.repeated_passages(docs).collect()
    assert {r["id"] for r in rows} | {r["other_id"] for r in rows} == set(range(60))
    assert len(rows) < 6 * 60


def test_an_occurrence_meets_all_of_its_seed_if_it_has_to(spark):
    """Eight pairs agree among 216 texts with the seed, whatever lies between them and
    whether the seed meets in one part (seed 1) or in four (seed 2)."""
    rows = []
    for seed, parts in ((1, 1), (2, 4)):
        for i in range(216):
            bits = 255 << 8 * (i // 2) if i < 16 else 1 << i % 64
            mask = bits - (1 << 64) if bits >= 1 << 63 else bits
            rows.append((seed, i, 10 * seed, mask, 0, parts))
    seeds = spark.createDataFrame(rows, f"{passages.SEED}, parts INT")
    links = passages._linked(seeds, Staging(spark)).distinct().collect()
    expected = {(2 * i + 1, 2 * i, 10 * seed, 10 * seed) for seed in (1, 2) for i in range(8)}
    assert {tuple(r) for r in links} == expected


def test_chains_equal_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randint(1, 12)
        pos = np.array([rng.randrange(40) for _ in range(n)])
        other = np.array([rng.randrange(40) for _ in range(n)])
        best = {}
        for i in sorted(range(n), key=lambda i: pos[i]):
            best[i] = 1 + max(
                [0]
                + [
                    best[j] - passages.GAP_COST * (pos[i] - pos[j] + other[i] - other[j])
                    for j in best
                    if pos[j] < pos[i] and other[j] < other[i]
                ]
            )
        first = passages.chains(pos, other)[0]
        gaps = sum(b[0] - a[0] + b[1] - a[1] for a, b in zip(first, first[1:], strict=False))
        assert abs(len(first) - passages.GAP_COST * gaps - max(best.values())) < 1e-9


def test_odd_rows_of_passages(odd_docs, no_docs):
    found = passages.repeated_passages(odd_docs).collect()
    assert {(r["id"], r["other_id"]) for r in found} <= {(1, 2), (2, 1)} and found
    assert passages.repeated_passages(no_docs).count() == 0


def _distance(item: str, text: str) -> int:
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_benchmark_search_equals_brute_force():
    rng = random.Random(4)
    letters = "abcdefgh "
    word = lambda low, high: "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))
    for _ in range(80):
        item = decontaminate.normalized(word(3, 120))
        changed = list(item)
        for _ in range(rng.randint(0, 8)):
            at = rng.randrange(len(changed) + 1)
            changed[at : at + rng.randint(0, 1)] = rng.choice(["", *letters])
        text = decontaminate.normalized(word(0, 60) + "".join(changed) + word(0, 60))
        found = decontaminate.BenchmarkIndex([(1, item)]).search(["x", text, "y"])
        least, most = _distance(item, text), decontaminate.budget(len(item))
        found = [f for f in found if f[0] == 1]
        assert bool(found) == (bool(item) and least <= most), (item, text)
        if found:
            assert found[0][4] == least


def test_decontamination_over_blocks_and_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    items = [(1, prose(1, 40)), (2, prose(77, 40)), (3, None), (4, ""), (None, prose(2, 30)), (5, "zq")]
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 100)
    found = decontaminate.benchmark_hits(odd_docs, bench).collect()
    assert {(r["id"], r["item_id"]) for r in found} == {(1, 1), (2, 1), (None, None)}
    assert decontaminate.benchmark_hits(no_docs, bench).count() == 0
    assert decontaminate.benchmark_hits(odd_docs, bench.where("false")).count() == 0


def test_members_that_no_leader_links_all_meet(spark):
    """The exact bounds never drop a similar pair, whatever it shares with a leader."""
    rng = random.Random(11)
    idf = np.full(minhash.WORD_BUCKETS, 1.5, np.float32)
    near = 0
    for i in range(60):
        base = prose(500 + i, rng.randint(40, 400))
        texts = [base, *(edited(base, rng.choice((45, 48, 50, 55, 70))) for _ in range(4))]
        sets = [minhash.weighted_shingles(words_of([t])[0], idf) for t in texts]
        profiles = np.stack([minhash.profile(*s) for s in sets])
        a, b = np.triu_indices(len(texts), 1)
        able = minhash.possible(profiles, a, b)
        for x, y, possible in zip(a, b, able, strict=True):
            if minhash.weighted_jaccard(sets[x], sets[y]) >= minhash.SIMILARITY:
                near += 1
                assert possible
    assert near > 100
    other = np.stack([minhash.profile(*minhash.weighted_shingles(words_of([prose(i, 200)])[0], idf)) for i in (1, 2)])
    assert not minhash.possible(other, np.array([0]), np.array([1])).any()


def test_pairs_of_a_bucket_are_verified_until_none_is_left(spark, monkeypatch):
    """One bucket for all, blocks of few rows: classes as by brute force."""
    monkeypatch.setattr(minhash, "BLOCK", 5)
    texts = []
    for i in range(8):
        base = prose(700 + i, 150)
        texts += [edited(base, every) for every in (60, 65, 70, 75, 80)]
    docs = _docs(spark, texts)
    keyed = docs.selectExpr("unhex(md5(text)) AS text_key", "text")
    counts, total = minhash.word_frequencies(docs, "text")
    idf = spark.sparkContext.broadcast(minhash.inverse_frequencies(counts, total))
    sets = {
        bytes(r["text_key"]): minhash.weighted_shingles(words_of([r["text"]])[0], idf.value)
        for r in keyed.collect()
    }
    keys = sorted(sets)
    leader = keys[0]
    state = [(1, bytearray(k), bytearray(leader)) for k in keys[1:]]
    state = spark.createDataFrame(state, "bucket BIGINT, text_key BINARY, leader BINARY")
    led = [
        (bytearray(leader), bytearray(k), minhash.weighted_jaccard(sets[leader], sets[k]))
        for k in keys[1:]
    ]
    led = spark.createDataFrame(led, "a BINARY, b BINARY, sim DOUBLE")
    staging = Staging(spark)
    linked = led.where(led["sim"] >= minhash.SIMILARITY)
    labels = component_labels(linked, staging)
    pairs = staging.save(minhash._beyond_leaders(state, led, labels, keyed, idf, staging), "pairs")
    got = {(bytes(r["a"]), bytes(r["b"])) for r in pairs.collect()}
    first = {bytes(r["node"]) for r in labels.collect()}
    similar = {
        (a, b)
        for a in keys[1:]
        for b in keys
        if a < b
        and not (a in first and b in first)
        and minhash.weighted_jaccard(sets[a], sets[b]) >= minhash.SIMILARITY
    }
    assert similar and similar <= got
    links, _ = minhash._in_rounds(pairs, linked, labels, keyed, idf, staging)
    assert all(r["sim"] >= minhash.SIMILARITY for r in links.collect())
    labels = component_labels(links, staging)
    found = {bytes(r["node"]): bytes(r["label"]) for r in labels.collect()}
    assert all(found[a] == found[b] for a, b in similar)


def test_rows_sent_to_blocks_grow_with_the_members_left_over(spark, monkeypatch):
    """A bucket with many members in its leader's class and few outside."""
    monkeypatch.setattr(minhash, "BLOCK", 10)

    def sent(inside, outside, sim=0.7):
        rows = [(1, bytearray(f"i{i}".encode()), 0.85, bytearray(b"x"), True) for i in range(inside)]
        rows += [(1, bytearray(f"o{i}".encode()), sim, bytearray(f"o{i}".encode()), False) for i in range(outside)]
        rows += [(2, bytearray(f"i{i}".encode()), 0.85, bytearray(b"x"), True) for i in range(50)]
        kind = "bucket BIGINT, text_key BINARY, sim DOUBLE, own BINARY, inside BOOLEAN"
        dealt = minhash._dealt(spark.createDataFrame(rows, kind)).collect()
        assert {r["bucket"] for r in dealt} <= {1}
        return sum(r["others"] for r in dealt)

    assert sent(1_000, 0) == 0
    assert sent(1_000, 1) == 1_000 + (100 + 1)
    assert sent(1_000, 30) == 3 * 1_000 + 30 * (100 + 3)
    assert sent(1_000, 1, sim=0.6) == 1, "too far from the leader for any of its class"


def test_a_text_with_very_many_copies(spark, conf):
    conf("spark.sql.shuffle.partitions", "4")
    texts = [prose(1, 100)] * 300 + [prose(i, 100) for i in range(2, 40)] + [edited(prose(1, 100), 90)]
    members, _ = minhash.near_duplicates(_docs(spark, texts))
    rows = {r["id"]: r for r in members.collect()}
    assert len(rows) == len(texts)
    assert all(rows[i]["class_id"] == (0 if i < 300 or i == len(texts) - 1 else i) for i in rows)
    assert rows[0]["class_texts"] == 2 and rows[0]["n_verified_links"] == 1


def test_names_of_documents_do_not_clash(spark):
    docs = _docs(spark, [prose(1, 100), prose(1, 100), None]).selectExpr(
        "*", "'k' AS _key", "'s' AS _stays", "'a' AS key", "'b' AS stays", "'c' AS row"
    )
    members, _ = minhash.near_duplicates(docs)
    kept = minhash.one_of_each(docs, members, "doc_id", "text")
    assert kept.columns == docs.columns
    assert sorted(kept.collect()) == sorted(docs.where("doc_id <> 1").collect())


def test_q_grams_of_very_many_items(monkeypatch):
    """Hits do not depend on what is left out, nor on the size of a run."""
    rng = random.Random(4)
    head = "question: which "
    items = [(i, head + prose(i, 25)) for i in range(60)] + [(60, head), (61, head), (62, prose(3, 30))]
    texts = []
    for i in range(40):
        item = list(items[rng.randrange(63)][1])
        for _ in range(rng.randint(0, 5)):
            item[rng.randrange(len(item))] = rng.choice("abc ")
        texts.append(decontaminate.normalized(prose(900 + i, 30) + " " + "".join(item) + " " + prose(950 + i, 20)))
    found, sizes = {}, {}
    for hot, most in ((10**9, 10**9), (5, 10**9), (5, 500)):
        monkeypatch.setattr(decontaminate, "HOT_ITEMS", hot)
        monkeypatch.setattr(decontaminate, "MOST_SHARED", most)
        index = decontaminate.BenchmarkIndex([(i, decontaminate.normalized(t)) for i, t in items])
        found[hot, most] = sorted(index.hits(texts))
        sizes[hot] = len(index.grams)
    assert found[10**9, 10**9] == found[5, 10**9] == found[5, 500]
    assert len(found[5, 500]) > 30 and sizes[5] < sizes[10**9] - 300


def test_blocks_are_read_one_after_the_other(spark, monkeypatch):
    items = [(i, prose(2000 + i, 30)) for i in range(40)]
    docs = _docs(spark, [prose(i, 20) + " " + items[i][1] for i in range(40)])
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    whole = sorted(decontaminate.benchmark_hits(docs, bench).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 1_000)
    names, save = [], Staging.save
    monkeypatch.setattr(Staging, "save", lambda self, df, name: (names.append(name), save(self, df, name))[1])
    found = decontaminate.benchmark_hits(docs, bench)
    assert names.count("hits") > 4 and names[0] == "items"
    assert sorted(found.collect()) == whole and {r["item_id"] for r in whole} == set(range(40))


def test_the_chains_of_a_pair_are_one_row(spark):
    """Two passages of two texts, far apart: their texts meet once."""
    links = [(2, 1, place, place + 500 * (place > 100)) for place in (5, 9, 13, 305, 309, 313)]
    found = passages._chained(spark.createDataFrame(links, "a BIGINT, b BIGINT, pos INT, other INT")).collect()
    assert [(r.a, r.b) for r in found] == [(2, 1)]
    assert sorted(found[0].pos) == [[5, 9, 13], [305, 309, 313]]
    assert sorted(found[0].other) == [[5, 9, 13], [805, 809, 813]]


def test_words_around_chains_tell_what_whole_texts_tell():
    """Cut texts give the alignment of whole ones, or say that they may not."""
    rng = random.Random(5)
    told, cut = 0, 0
    for _ in range(300):
        shared = [rng.randrange(1, 400) for _ in range(rng.choice((40, 80, 300)))]
        copy = [x if rng.random() > 0.12 else 0 for x in shared]
        around = lambda: [rng.randrange(1, 400) for _ in range(rng.choice((0, 20, 200)))]
        a, b = (np.array(around() + x + around(), np.uint64) for x in (shared, copy))
        seeds = [
            (p, o) for p in range(len(a) - 3) for o in range(len(b) - 3)
            if a[p] == b[o] and np.array_equal(a[p : p + 4], b[o : o + 4])
        ]
        for chain in passages.chains(*map(np.array, zip(*rng.sample(seeds, min(3, len(seeds))), strict=True))) if seeds else []:
            spans = [(max(0, x[0] - 64), x[-1] + 4 + 64) for x in zip(*chain, strict=True)]
            (p, p_end), (o, o_end) = spans
            ends = (p > 0, o > 0), (p_end < len(a), o_end < len(b))
            moved = [(x - p, y - o) for x, y in chain]
            try:
                found = passages.passages_of(a[p:p_end], b[o:o_end], moved, ends)
            except passages.Cut:
                cut += 1
                continue
            told += 1
            back = [(s + p, e + p, t + o, u + o, equal) for s, e, t, u, equal in found]
            assert back == passages.passages_of(a, b, chain)
    assert told > 200 and cut > 20


def test_whole_texts_go_only_to_chains_that_go_on(spark, monkeypatch):
    """Pairs that agree around one seed alone end there; long common stretches
    are still found whole."""
    sent = []
    aligned = passages._aligned
    monkeypatch.setattr(passages, "_aligned", lambda rows: sent.append(rows.count()) or aligned(rows))
    shared = prose(50, 20)
    texts = [f"{prose(100 + i, 300)} {shared} {prose(200 + i, 300)}" for i in range(40)]
    long = prose(60, 900)
    texts += [f"{prose(300, 100)} {long}", f"{long} {prose(301, 100)}"]
    rows = passages.repeated_passages(_docs(spark, texts)).collect()
    assert {(r["id"], r["other_id"]) for r in rows} <= {(40, 41), (41, 40)}
    assert {(r["stop"] - r["start"], r["equal"]) for r in rows} >= {(900, 1.0)}
    assert sum(sent) <= 1
