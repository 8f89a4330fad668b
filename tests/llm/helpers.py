"""Small documents with what the operators must stand: nulls, empty and long
texts, copies, near copies and ties."""
import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, tokens string, bucket long"


def prose(rng, n):
    return " ".join(rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(n))


def documents(spark, seed=1):
    rng = random.Random(seed)
    texts = [prose(rng, rng.choice([3, 8, 30, 120, 300])) for _ in range(60)]
    long = prose(rng, 6000)
    copies = [texts[4], texts[4], texts[7].upper(), long, long]
    near = [" ".join(w if rng.random() > 0.03 else "edit" for w in texts[i].split()) for i in (4, 5, 6, 7, 8, 8, 8)]
    lines = ["\n".join([prose(rng, 9), texts[2], prose(rng, 12), " "]) for _ in range(4)]
    passage = prose(rng, 70)
    shared = [f"{prose(rng, 20)} {passage} {prose(rng, 15)}" for _ in range(4)]
    every = [*texts, *copies, *near, *lines, *shared, None, "", " \n\t ", "one", "...!", "ÄÖ ñ é"]
    rows = [
        (i, t, None if i % 9 == 0 else "xx" if i % 2 else "yy", None if i % 7 == 0 else f"s{i % 3}", 0, "s", "t", 1)
        for i, t in enumerate(every)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def lowered(text):
    return (text or "").encode().translate(FOLD).split()
