"""Near copies in nodes of many documents, against brute force."""
import random

import pytest

import corpus_pipeline
from mercaflow.llm import near_dup
from mercaflow.llm.near_dup import near_duplicates


def _roots(texts, width=2):
    sets = [set(zip(*[w[k:] for k in range(width)])) for w in map(str.split, texts)]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for b in range(len(sets)):
        for a in range(b):
            shared = len(sets[a] & sets[b])
            if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(texts))]


def _path(rng, n, words=200, changed=9):
    """Texts that are similar to their neighbours in the path only."""
    text, texts = [f"w{k}" for k in range(words)], []
    for step in range(n):
        texts.append(" ".join(text))
        for k in rng.sample(range(words), changed):
            text[k] = f"s{step}x{k}"
    return texts


def _variants(rng, n, words, changed):
    base = [f"b{k}" for k in range(words)]
    return [" ".join(f"v{rng.randrange(10**9)}" if rng.random() < changed else w for w in base) for _ in range(n)]


def _found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = near_duplicates(docs, 2).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return [r.component_id for r in sorted(rows, key=lambda r: r.doc_id)]


def test_a_path_of_similar_documents_is_one_component(spark):
    texts = _path(random.Random(5), 60)
    assert _roots(texts) == [0] * 60
    assert _found(spark, texts) == [0] * 60


@pytest.mark.parametrize("small, block", [(near_dup.SMALL, near_dup.BLOCK_DOCS), (32, 40)])
def test_crowds_with_links_and_bridges(spark, monkeypatch, small, block):
    """Variants that lie around the threshold, of which some have a path of their own."""
    monkeypatch.setattr(near_dup, "SMALL", small)
    monkeypatch.setattr(near_dup, "BLOCK_DOCS", block)
    rng = random.Random(7)
    texts = _variants(rng, 150, 120, 0.055) + _variants(rng, 100, 120, 0.01)
    for text in texts[:3]:
        words = text.split()
        for _ in range(8):
            for k in rng.sample(range(120), 5):
                words[k] = f"p{rng.randrange(10**9)}"
            texts.append(" ".join(words))
    rng.shuffle(texts)
    wanted = _roots(texts)
    assert 10 < len(set(wanted)) < len(texts) - 50
    assert _found(spark, texts) == wanted


def test_the_pipeline_keeps_one_document_of_a_crowd(spark):
    rng = random.Random(9)
    texts = _variants(rng, 120, 400, 0.014)
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    kept = corpus_pipeline.one_of_near_copies(spark, docs, "")
    wanted = _roots(texts, 5)
    assert 5 < len(set(wanted)) < 90
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(wanted))
