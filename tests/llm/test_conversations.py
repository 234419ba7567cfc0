import hashlib
import itertools
import random
import re
import zlib

import pytest

from tickloom.llm import conversations as cv
from tickloom.llm.queries import QUERIES

WHITE = " \t\n\x0b\x0c\r"
TO = {"": "s", "s": "u", "u": "a", "a": "u"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        sp = lambda x: " " if x is None else str(x)
        k = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        role, text = sp(role), sp(text)
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def cheapest(signs):
    """Least (cost, audit) over grammar states by plain forward search over whole audit strings."""
    best = {"": (0, "")}  # last initial -> what led there

    def inserted(best):
        for _ in range(3):
            for q, (c, a) in list(best.items()):
                for x in "ua":
                    if (q, x) in ALLOWED:
                        best[x] = min(best.get(x, (10**9, "")), (c + 5, a + "I"))
        return best

    for initial, fault in signs:
        best, new = inserted(dict(best)), {}

        def way(q, c, a):
            new[q] = min(new.get(q, (10**9, "")), (c, a))

        for q, (c, a) in best.items():
            way(q, c + 2, a + "D")
            if fault not in ("b", "d"):
                extra = 5 * (fault == "t")
                if (q, initial) in ALLOWED:
                    way(initial, c + extra, a + "K")
                for x in "ua":
                    if (q, x) in ALLOWED:
                        way(x, c + 1 + extra, a + "R")
        best = new
    best = inserted(best)
    return min(best[q] for q in ("", "a") if q in best)


ALLOWED = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}


def brute(rows):
    out = {}
    after = {}
    for r in damaged(rows):
        after.setdefault(r[0], []).append(r)
    for conv in {r[0] for r in rows}:
        own = sorted(after.get(conv, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        seen, signs, count = set(), [], {"b": 0, "d": 0, "t": 0, "": 0}
        for _, _, role, text in own:
            s = text.strip(WHITE)
            f = "b" if not s else "d" if (role, text) in seen else "t" if s[-1] not in ".!?" else ""
            seen.add((role, text))
            count[f] += 1
            signs.append((role[:1], f))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(signs, signs[1:]))
        turns = {r[1] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = cheapest(signs)
        lines, q, k = [], "", 0
        for e in audit:
            role, text = own[k][2:] if e != "I" else ("", "")
            if e in "IR":
                q = "a" if q == "u" else "u"
                lines.append({"u": "user", "a": "assistant"}[q] + ":" + text)
            elif e == "K":
                q = role[0]
                lines.append(f"{role}:{text}")
            k += e != "I"
        assert k == len(own) and re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, count["b"], count["d"], count["t"], illegal, cost, audit, sha)
    return out


def rows_of(df):
    got = {}
    for r in df.collect():
        assert r.conv_id not in got
        got[r.conv_id] = tuple(r)[1:]
    return got


def test_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(QUERIES["op13_conversation_repair"](spark, sf_dir)) == brute(rows)


def test_every_short_signature():
    """All words of up to five letters, in order and out of it; each ending is made once in order."""
    signs = [(i, f) for i in "suao" for f in ("", "t")] + [("u", "b")]
    words = sorted((w for n in range(5) for w in itertools.product(signs, repeat=n)), key=lambda w: [cv.letter(*s) for s in w][::-1])
    auto = cv.SuffixAutomaton()
    for w in words:
        assert auto.repair("".join(cv.letter(*s) for s in w)) == cheapest(w)
    assert auto.made == len({tuple(w[k:]) for w in words for k in range(len(w) + 1)})
    rng = random.Random(5)
    for w in rng.sample(words, 500) + [[rng.choice(signs) for _ in range(60)] for _ in range(20)]:
        assert auto.repair("".join(cv.letter(*s) for s in w)) == cheapest(w)


def test_long_conversation():
    """Nodes take 33 bytes a row, so one of 200,000 rows fits; its cost adds up from its parts."""
    auto = cv.SuffixAutomaton()
    cost, audit = auto.repair("ua" * 100_000)
    assert (cost, audit) == (0, "K" * 200_000)
    assert auto.repair("uua" * 50_000)[0] == 3 * 25_000  # of each two times uua three rows change


def odd_rows():
    rng = random.Random(3)
    roles = ["user", "assistant", "system", None, "", "tool", "uncle", "User"]
    texts = ["One.", "Two!", "three", "", " \t\n", None, "Is it? ", " ", "x" * 5000 + ".", "é\U0001f600"]
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, 0, 1, 2, 3, 5, 9, -4]), rng.choice(roles), rng.choice(texts)) for _ in range(900)]
    return rows + rows[:200]


def test_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], "conv_id long, turn long, role string, text string, signature string, dropped int")
    assert rows_of(cv.repairs(cv.damage(df))) == brute(rows)


def test_all_rows_dropped(spark):
    gone = [(c, 0, "user", "Hi.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    df = spark.createDataFrame(gone, "conv_id long, turn long, role string, text string")
    got = rows_of(cv.repairs(cv.damage(df)))
    assert len(got) == len(gone) and set(got.values()) == {(0,) * 6 + ("", hashlib.sha256().hexdigest())}
    assert cv.repairs(cv.damage(df.limit(0))).collect() == []


@pytest.mark.parametrize("same", ["one signature", "one conversation"])
def test_hot_groups(spark, same):
    """A signature that all share, and a conversation with all rows."""
    rows = [(k // 2 if same == "one signature" else 7, k % 2 if same == "one signature" else k, ["user", "assistant"][k % 2], f"Text {k}.") for k in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert rows_of(cv.repairs(cv.damage(df))) == brute(rows)
