"""Conversation repair against a plain search for the cheapest edits."""
import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from mercaflow.llm import conversation_repair as module
from mercaflow.llm.conversation_repair import piece_edits, repair, repaired_turns
from mercaflow.llm.damaged_view import damaged

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256().hexdigest()


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows):
    """Cost, audit and lines by trying all edits of a short conversation."""
    faults = faults_of(rows)

    @lru_cache(maxsize=None)
    def best(i, initials, inserted):
        if not re.fullmatch(r"s?(ua)*u?", initials):
            return None
        options = []
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", initials):
            options.append((0, "", ()))
        # What is behind matters by its last initial only.
        behind = lambda x: initials[-2:] + x if initials[-1:] == "a" else initials + x
        edits = [("I", 2, r, f"{r}:", i, inserted + 1) for r in ("user", "assistant") if inserted < 2]
        if i < len(rows):
            (role, text), fault = rows[i], faults[i]
            edits.append(("D", 3, "", None, i + 1, 0))
            if fault in ("", "truncated"):
                extra = fault == "truncated"
                if role[:1] in ("s", "u", "a"):
                    edits.append(("K", extra, role, f"{role}:{text}", i + 1, 0))
                edits += [("R", 2 + extra, r, f"{r}:{text}", i + 1, 0) for r in ("user", "assistant")]
        for letter, cost, role, line, after, n in edits:
            rest = best(after, behind(role[:1]) if role else initials, n)
            if rest is not None:
                options.append((cost + rest[0], letter + rest[1], (() if line is None else (line,)) + rest[2]))
        return min(options, default=None)

    return best(0, "", 0)


def expected(rows_of, originals):
    out = {}
    for conv in originals:
        rows = rows_of.get(conv, [])
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
        turns = [t for t, *_ in rows if t is not None]
        pairs = [(a[1][:1] + b[1][:1]) for a, b in zip(rows, rows[1:])]
        faults = faults_of([r[1:] for r in rows])
        cost, audit, lines = cheapest(tuple(r[1:] for r in rows)) if rows else (0, "", ())
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(x) for x in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def conversations(seed, n):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "and so", "", " \t", "a b.\n", "Ünd…", "fine. ", "x"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "a"]
    rows = []
    for conv in range(n):
        turn = 0
        for _ in range(rng.randrange(1, 8)):
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
            turn += rng.choice([1, 1, 1, 1, 3])
    rows += [(None, 0, "user", "Hi."), (None, None, None, None), (None, 2, "assistant", None), (n, None, "system", "S.")]
    return rows


def grouped(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return out


@pytest.mark.parametrize("bits", [1, 16])
def test_cheapest_edits(spark, monkeypatch, bits):
    """Pieces of two rows, and whole conversations."""
    monkeypatch.setattr(module, "PIECE_BITS", bits)
    rows = conversations(bits, 150)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    every = spark.createDataFrame([(c,) for c in [*{r[0] for r in rows}, 777]], "conv_id long")
    got = {r[0]: tuple(r[1:]) for r in repair(df, every).collect()}
    assert got == expected(grouped(rows), [*{r[0] for r in rows}, 777])
    assert got[777] == (0, 0, 0, 0, 0, 0, "", EMPTY)


def test_repaired_turns_have_the_pattern(spark):
    rows = conversations(9, 60)
    df = spark.createDataFrame(rows, SCHEMA)
    turns = {}
    for r in sorted(repaired_turns(df).collect(), key=lambda r: (str(r.conv_id), r.position)):
        turns.setdefault(r.conv_id, []).append(r)
    digests = {r.conv_id: r.repaired_sha256 for r in repair(df).collect()}
    for conv, out in turns.items():
        assert [r.position for r in out] == list(range(len(out)))
        assert re.fullmatch("s?(ua)+", "".join(r.role[:1] for r in out))
        lines = "\n".join(f"{r.role}:{r.text}" for r in out)
        assert hashlib.sha256(lines.encode()).hexdigest() == digests[conv]
    assert all(digests[c] == EMPTY for c in digests if c not in turns)


def test_a_long_conversation_in_many_pieces(spark, monkeypatch):
    """Most rows in one conversation: pieces give what one piece gives."""
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "user", "assistant", "system"]), f"{t // 3}" + rng.choice([".", ""])) for t in range(3000)]
    rows += [(2, 5, "user", "x" * 200_000), (2, 5, "user", "x" * 200_000), (2, 9, "assistant", "Yes.")]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = sorted(repair(df).collect())
    monkeypatch.setattr(module, "PIECE_BITS", 5)
    assert sorted(repair(df).collect()) == whole
    assert whole[1].audit == "KDK" and whole[1].gaps == 3 and whole[1].truncated == 1


def test_runs_equal_single_steps():
    rng = random.Random(2)
    for _ in range(300):
        symbols = "".join(rng.choice("abcdefghijkl") * rng.randrange(1, 9) for _ in range(4))
        vector = module._END
        for s in reversed(symbols):
            vector = module._apply(module._power(ord(s) - 97, 0), vector)
        assert module._apply(module.piece_matrix(symbols), module._END) == vector
        audit, state = piece_edits(symbols, module._END, 0)
        cost = {"D": 3, "I": 2, "K": 0, "R": 2}
        rows = re.findall("I*[DKR]", audit)
        assert len(rows) == len(symbols)
        extra = sum("K" in r + "K" * ("R" in r) and (ord(s) - 97) % 3 == 1 for r, s in zip(rows, symbols))
        assert sum(cost[x] for x in audit + module._tail(state)) + extra == vector[0]


def test_damage_follows_from_the_key(spark):
    rows = [(c, t, "assistant", f"One. Two? {t}!") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    want = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        want += [(conv, turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    got = [tuple(r) for r in damaged(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len({r[3] for r in want}) > 3


def test_empty_table_and_other_columns(spark):
    nothing = spark.createDataFrame([], SCHEMA + ", audit string, seq long, conv string")
    assert repair(nothing).count() == 0 and repaired_turns(nothing).count() == 0
    one = spark.createDataFrame([(1, 0, "tool", "x", "a", 9, "c")], nothing.schema)
    assert repair(one).first().audit == "D" and repair(one).first().cost == 3
