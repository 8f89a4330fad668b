"""The operators on documents against brute force, on a table that holds the
awkward cases, and on an empty one."""
import collections
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from mercaflow.llm import language, line_dedup
from mercaflow.llm.decontaminate import benchmark_hits, decontaminate, longest_matches
from mercaflow.llm.line_dedup import dedup_lines
from mercaflow.llm.mixture import mix_sources, with_texts
from mercaflow.llm.near_dup import near_duplicates
from mercaflow.llm.ngram_lm import score_corpus
from mercaflow.llm.substring_dedup import remove_repeats
from mercaflow.llm.token_counts import token_counts
from tests.llm.helpers import FOLD, documents, lowered, texts_of


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.filter("false")


def components(count, links):
    parent = {i: i for i in count}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in parent}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, docs, width):
    sets = {}
    for i, text in texts_of(docs).items():
        w = lowered(text)
        sets[i] = set(zip(*[w[k:] for k in range(width)])) if len(w) >= width else {tuple(w)} - {()}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    root = components(sets, links)
    got = {r[0]: r[1:] for r in near_duplicates(docs, width).collect()}
    assert got == {i: (len(sets[i]), root[i], root[i] == i) for i in sets}


def test_near_duplicates_of_rows_without_id_and_repeated_rows(spark, nothing):
    rows = [(None, "a b c"), (None, "a b c"), (3, "a b c"), (3, "a b c"), (2, "A b  c"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter(near_duplicates(df, 2).select("doc_id", "component_id", "kept").collect())
    assert got == {(None, None, True): 2, (3, 2, False): 2, (2, 2, True): 1, (9, 9, True): 1}
    assert near_duplicates(nothing).collect() == []


def test_benchmark_hits(spark, docs, nothing):
    texts = texts_of(docs)
    items = [(1, texts[5]), (2, "ONE"), (3, None), (4, " "), (2, texts[6]), (None, texts[7]), (10, "edit " + texts[5][:200])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = collections.defaultdict(set)
    for item, text in items:
        w = word.findall((text or "").encode().translate(FOLD))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(item)
    for row in benchmark_hits(docs, benchmark).collect():
        w = word.findall((texts[row.doc_id] or "").encode().translate(FOLD))
        hit, found = set(), set()
        for length in {len(x) for x in windows}:
            for k in range(len(w) - length + 1):
                if own := windows.get(tuple(w[k : k + length])):
                    hit.update(range(k, k + length))
                    found |= own
        assert row.n_words == len(w)
        assert {k for s in row.spans for k in range(s.begin, s.end)} == hit
        assert row["items"] == sorted(str(x) for x in found if x is not None)
    clean = decontaminate(docs, benchmark)
    hits = benchmark_hits(docs, benchmark).filter("size(spans) = 0")
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in hits.collect())
    best = {r.item_id: r for r in longest_matches(docs, benchmark).collect()}
    assert best["1"].n_words == len(word.findall(texts[5].encode()))
    assert decontaminate(docs, benchmark.filter("false")).count() == docs.count()
    assert benchmark_hits(nothing, benchmark).collect() == []


def test_repeated_windows_are_removed(docs, nothing):
    words = {i: (t or "").encode().split() for i, t in texts_of(docs).items()}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 49):
            first.setdefault(tuple(words[i][k : k + 50]), i)
    removed = 0
    for row in remove_repeats(docs).collect():
        w = words[row.doc_id]
        gone = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < row.doc_id:
                gone.update(range(k, k + 50))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
        assert (row.n_words, row.n_removed, row.kept_text) == (len(w), len(gone), kept)
        removed += len(gone)
    assert removed > 200
    assert remove_repeats(nothing).collect() == []


@pytest.mark.parametrize("broadcast_bytes", [line_dedup.BROADCAST_BYTES, 0])
def test_lines_similar_to_earlier_ones_go(docs, nothing, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", broadcast_bytes)
    monkeypatch.setattr(line_dedup, "PART_BYTES", broadcast_bytes or 100)
    texts = texts_of(docs)
    earlier, gone = [], collections.defaultdict(set)
    for i in sorted(texts):
        for k, line in enumerate((texts[i] or "").split("\n")):
            tokens = set(lowered(line))
            if tokens:
                if any(100 * len(tokens & e) >= 80 * len(tokens | e) for e in earlier):
                    gone[i].add(k)
                earlier.append(tokens)
    got = dedup_lines(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_removed_lines"]
    for row in got.collect():
        text = texts[row.doc_id]
        kept = None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone[row.doc_id])
        assert (row.text, row.n_removed_lines) == (kept, len(gone[row.doc_id]))
    assert dedup_lines(nothing).collect() == []


def test_scores_follow_the_smoothed_bigrams(docs, nothing):
    tokens = {i: [*lowered(t), b"</s>"] for i, t in texts_of(docs).items()}
    learns = F.col("doc_id") % 3 != 0
    single, pair = collections.Counter(), collections.Counter()
    for i, w in tokens.items():
        if i % 3:
            single.update(w)
            pair.update(zip([b"</s>", *w], w))
    total, distinct = sum(single.values()), len(single)
    context, fan = collections.Counter(), collections.Counter()
    for (a, _), n in pair.items():
        context[a] += n
        fan[a] += 1

    def discount(counts):
        once, twice = (sum(v == n for v in counts.values()) for n in (1, 2))
        return once / (once + 2 * twice)

    d1, d2 = discount(single), discount(pair)
    for batch_words, shard_words in ((1 << 20, 10**6), (500, 2000)):
        got, expected = 0.0, 0.0
        rows = score_corpus(docs, learns, batch_words, shard_words).collect()
        assert sorted(r.doc_id for r in rows) == sorted(tokens)
        for row in rows:
            w = tokens[row.doc_id]
            base = sum(math.log10((single[x] + 1) / (total + distinct + 1)) for x in w)
            score = 0
            for a, b in zip([b"</s>", *w], w):
                p = (single[b] - d1) / total if single[b] else d1 * distinct / total
                if context[a]:
                    p = max(pair[a, b] - d2, 0) / context[a] + d2 * fan[a] / context[a] * p
                score += math.log10(p)
            assert row.held_out == (row.doc_id % 3 == 0)
            assert (row.n_tokens, row.n_known, row.train_tokens) == (len(w), sum(x in single for x in w), total)
            assert row.base_score == pytest.approx(base, rel=1e-9)
            # Each shard has a discount of its own, so only one shard is held to every score.
            if shard_words == 10**6:
                assert row.score == pytest.approx(score, abs=0.02 * len(w) + 0.05)
            got, expected = got + row.score, expected + score
        assert got == pytest.approx(expected, rel=0.05)
    assert score_corpus(nothing, learns).collect() == []


def test_the_mix_meets_its_targets(docs, nothing):
    taken, sizes = mix_sources(docs)
    pieces = with_texts(taken, docs).collect()
    words = {i: (t or "").encode().split() for i, t in texts_of(docs).items()}
    rows = sizes.collect()
    assert {r.doc_id: r["size"] for r in rows} == {i: len(w) for i, w in words.items()}
    assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(sum(map(len, words.values())))
    by_source, by_doc = collections.Counter(), collections.Counter()
    for p in pieces:
        by_source[p.source] += p.n_words
        by_doc[p.doc_id] += p.n_words
        assert p.text.encode() in b" ".join(words[p.doc_id]) and len(p.text.split()) == p.n_words
    for r in rows:
        assert abs(by_source[r.source] - r.target) <= 0.5
        assert by_doc[r.doc_id] <= 3 * r["size"]
    again = with_texts(mix_sources(docs)[0], docs)
    assert collections.Counter(again.collect()) == collections.Counter(pieces)
    taken, sizes = mix_sources(nothing)
    assert taken.collect() == [] and sizes.collect() == []


def test_token_counts(docs, nothing):
    expected = {i: len((t or "").encode().split()) for i, t in texts_of(docs).items()}
    assert {r.doc_id: r.n_tokens for r in token_counts(docs).collect()} == expected
    assert token_counts(nothing).collect() == []


def test_languages_are_told_apart(spark, docs, nothing):
    rng = __import__("random").Random(3)
    word = {"aa": "bcdfa", "zz": "xyzwe"}
    rows = [
        (i, " ".join("".join(rng.choices(word[lang], k=5)) for _ in range(rng.choice([2, 40]))), lang)
        for i, lang in enumerate(["aa", "zz"] * 40)
    ] + [(100, None, "aa"), (101, "12 !", "zz"), (102, "", None), (103, "xyzw " * 300_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df.filter("doc_id % 5 <> 0 and doc_id < 100"))
    got = {r.doc_id: r for r in language.predict(df, model).collect()}
    assert all(got[i].lang_pred == lang and got[i].score > 0.5 for i, _, lang in rows[:80])
    assert [got[i].lang_pred for i in (100, 101, 102, 103)] == ["und", "und", "und", "zz"]
    assert language.fit(nothing) is None
    assert {r.lang_pred for r in language.predict(df, None).collect()} == {"und"}
    assert sorted(r.doc_id for r in language.in_known_language(df, model).collect()) == [*range(80), 103]


def test_short_lines_that_repeat_go(spark):
    texts = {
        1: "one\n- -\n\na b c\nx y z w\np q r s t",
        2: "ONE\n-\n\nc a b\nx y z\nw z y x v\nq p r s",
        3: "two\n-\t-\n \nb c\nONE one\nx y z u",
    }
    rows = list(texts.items())
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # Four of five different tokens are similar, three of four are not.
    assert got == {1: texts[1], 2: "\nx y z", 3: "two\n \nb c\nx y z u"}
    earlier = []
    for i, text in rows:
        kept = []
        for line in text.split("\n"):
            tokens = set(lowered(line))
            if not (tokens and any(100 * len(tokens & e) >= 80 * len(tokens | e) for e in earlier)):
                kept.append(line)
            if tokens:
                earlier.append(tokens)
        assert got[i] == "\n".join(kept)


def test_every_place_of_a_passage_is_removed(spark):
    passages = [" ".join(f"{name}{k}" for k in range(n)) for name, n in (("a", 9), ("b", 9), ("c", 45), ("p", 60), ("d", 45))]
    a, b, c, p, d = passages
    rows = [(1, f"{a} {p} {b}"), (2, f"{c} {p} {d} x {c} {p} {d}"), (3, f"{d} x {c} {p} {d}")]
    got = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_removed, got[2].n_removed) == (0, 120)
    assert got[2].kept_text == f"{c} {d} x {c} {d}"
    assert (got[3].n_removed, got[3].kept_text) == (got[3].n_words, "")


def test_scores_do_not_depend_on_the_batch(spark):
    rng = __import__("random").Random(4)
    rows = [(i, " ".join(f"the w{rng.randrange(60)}" for _ in range(5))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    learns = F.col("doc_id") % 4 != 0
    # 22 shards, which all have successors of "the"; a small batch asks few of them.
    whole = {r.doc_id: r for r in score_corpus(df, learns, 1 << 20, 200).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        small = {r.doc_id: r for r in score_corpus(df, learns, 10, 200).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(whole) == sorted(small) == list(range(400))
    for i, row in whole.items():
        assert small[i].score == pytest.approx(row.score, rel=1e-6)
        assert small[i].base_score == pytest.approx(row.base_score, rel=1e-9)


def test_long_lines_repeated_rows_and_similar_lines_of_many_sizes(spark):
    """Against brute force: lines of up to thousands of tokens, and a crowd of
    variants of one template."""
    rng = random.Random(8)
    base = [f"t{k}" for k in range(60)]
    lines = [" ".join(w if rng.random() > 0.1 else f"v{rng.randrange(50)}" for w in base[: rng.randrange(3, 60)]) for _ in range(400)]
    long = [f"l{k}" for k in range(5000)]
    lines += [" ".join(long), " ".join(long[:4001]), " ".join(long[:3999] + ["x", "y"]), " ".join(reversed(long[:4100]))]
    rows = [(i // 4, "\n".join(lines[i : i + 4]), "n") for i in range(0, len(lines), 4)]
    rows += [rows[3], (1000, None, "n"), (None, lines[0], "n"), (1001, "\n\n", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string")
    earlier, gone = [], collections.defaultdict(set)
    for i, text in sorted({(i, t) for i, t, _ in rows if i is not None and t}):
        for k, line in enumerate(text.split("\n")):
            tokens = set(line.split())
            if tokens:
                if any(100 * len(tokens & e) >= 80 * len(tokens | e) for e in earlier):
                    gone[i].add(k)
                earlier.append(tokens)
    assert sum(map(len, gone.values())) > 50
    out = dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "n_lines", "n_removed_lines"]
    got = collections.Counter((r.doc_id, r.text, r.n_removed_lines) for r in out.collect())
    want = collections.Counter(
        (i, t if not t or i not in gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]), len(gone.get(i, ())))
        for i, t, _ in rows
    )
    assert got == want
