import hashlib
import random
import zlib
from itertools import product

import pytest

from shelfcast.llm import repair as R

SCHEMA = "conv_id long, turn long, role string, text string, pos string, cost string, block string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


SPACE = " \t\n\v\f\r"


def faults_of(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(SPACE)
        if not body:
            found.append("b")
        elif (role, text) in seen:
            found.append("d")
        else:
            found.append("." if body[-1] in ".!?" else "t")
        seen.add((role, text))
    return "".join(found)


def legal(roles):
    initials = "".join(r[:1] for r in roles)
    body = initials[1:] if initials.startswith("s") else initials
    return initials == "" or (len(body) > 0 and len(body) % 2 == 0 and body == "ua" * (len(body) // 2))


def cheapest(rows, faults):
    """All edit sequences with at most two inserts before a row or at the end."""
    fillers = [f for n in range(3) for f in product(("user", "assistant"), repeat=n)]
    options = []
    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        own = [(2, "D", [])]
        if fault not in "bd":
            more = 5 if fault == "t" else 0
            own.append((more, "K", [(role, text)]))
            own += [(more + 1, "R", [(r, text)]) for r in ("user", "assistant")]
        options.append([
            (5 * len(f) + c, "I" * len(f) + a, [(r, "") for r in f] + o) for f in fillers for c, a, o in own
        ])
    options.append([(5 * len(f), "I" * len(f), [(r, "") for r in f]) for f in fillers])
    states = {(): (0, "", [])}  # by initials so far: all that the grammar looks at
    for own in options:
        after = {}
        for key, (cost, audit, out) in states.items():
            for c, a, o in own:
                roles = [*key, *(r[:1] for r, _ in o)]
                if "".join(roles) != ("s" if roles[:1] == ["s"] else "") + (
                    "ua" * len(roles))[: len(roles) - (roles[:1] == ["s"])]:
                    continue
                new = (cost + c, audit + a, out + o)
                short = tuple(roles)
                if short not in after or new[:2] < after[short][:2]:
                    after[short] = new
        states = after
    return min((v for k, v in states.items() if legal(k)), key=lambda v: v[:2])


def brute(rows):
    result = {}
    after = damaged(rows)
    for conv in {r[0] for r in rows}:
        own = [r for r in after if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3][:32].encode(),
                                hashlib.sha256(r[3].encode()).digest()))
        faults = faults_of(own)
        cost, audit, out = cheapest(own, faults)
        initials = [r[2][:1] for r in own]
        turns = [r[1] for r in own if r[1] is not None]
        result[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            faults.count("b"), faults.count("d"), faults.count("t"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
        )
    return result


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 8)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool"])
            if rng.random() < 0.6:
                role = ["user", "assistant"][turn % 2]
            text = rng.choice(["Yes.", "no", "Why? ", "", " \n", f"Text {rng.randrange(5)}!", "é."])
            rows.append((conv, turn, role, text))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)


def report(spark, rows):
    df = table(spark, rows)
    found = R.repair_report(df, R.in_order(R.damage(df))).collect()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    by_id = {r.conv_id: tuple(r[n] for n in names) for r in found}
    assert len(by_id) == len(found)
    return by_id


def test_equals_brute_force(spark):
    rows = conversations(1, 150)
    rows += [(-1, None, "user", "a."), (-1, None, "assistant", "b."), (-1, 3, None, None), (-1, 9, "", "x.")]
    rows += [(None, 0, "user", "q?"), (None, 1, "assistant", None), (None, None, None, "z.")]
    rows += [(500, 4, "user", "same."), (500, 4, "user", "same."), (500, 4, "assistant", "other.")]
    rows += [(501, i, "system", "s.") for i in range(3)]
    rows += [(502, 0, "user", "long " * 50_000 + "."), (502, 1, "assistant", "ok.")]
    rows += [r for r in ((900 + i, i % 40, "user", "x.") for i in range(60))
             if zlib.crc32(f"{r[0]}:{r[1]}".encode()) % 20 == 0][:2]  # conversations that are dropped whole
    assert report(spark, rows) == brute(rows)


def test_long_conversations_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_BITS", 2)
    rng = random.Random(5)
    rows = conversations(2, 20)
    rows += [(99, i, rng.choice(["user", "assistant"]), f"{i % 17}{rng.choice(['.', ''])}") for i in range(60)]
    df = table(spark, rows)
    turns = R.in_order(R.damage(df))
    assert turns.where("conv_id = 99").select("block").distinct().count() > 5
    found = R.repairs(R.faults_of(turns))
    by_id = {r.conv_id: (r.cost, r.audit, r.illegal) for r in found.collect()}
    short = {c: v for c, v in brute([r for r in rows if r[0] != 99]).items() if c in by_id}
    assert {c: by_id[c] for c in short} == {c: (v[5], v[6], v[4]) for c, v in short.items()}
    # the long one: in one piece
    own = sorted((r for r in damaged(rows) if r[0] == 99),
                 key=lambda r: (r[1], r[2], r[3][:32], hashlib.sha256(r[3].encode()).digest()))
    whole = R.cheapest({R.START: R.parse("".join(r[2][0] for r in own), faults_of(own), R.START)})
    assert by_id[99][:2] == whole
    repaired = R.repaired_rows(turns, found).where("conv_id = 99").orderBy("pos", "place").collect()
    lines = "\n".join(f"{r.role}:{r.text}" for r in repaired)
    hashes = {r.conv_id: r.repaired_sha256 for r in R.repaired_hashes(turns, found).collect()}
    assert hashes[99] == hashlib.sha256(lines.encode()).hexdigest()
    assert legal([r.role for r in repaired])
    assert "".join(r.edit for r in repaired) == whole[1].replace("D", "")


def test_tables_compose_like_one_parse():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(1, 14)
        initials = "".join(rng.choice("suax") for _ in range(n))
        faults = "".join(rng.choice("...tbd") for _ in range(n))
        cuts = sorted(rng.sample(range(1, n), min(n - 1, 3)))
        parts = [slice(a, b) for a, b in zip([0, *cuts], [*cuts, n])]
        tables = [{s: R.parse(initials[p], faults[p], s) for s in R.STACKS} for p in parts]
        assert R.compose_all(tables)[R.START] == R.parse(initials, faults, R.START)


@pytest.mark.parametrize("text, legal_moves", [("u", {(0, 2), (1, 2), (3, 2)}), ("a", {(2, 3)}), ("s", {(0, 1)})])
def test_automaton(text, legal_moves):
    assert {(top, after) for (top, c), after in R.MOVES.items() if c == text} == legal_moves


def test_empty_table(spark):
    assert report(spark, []) == {}
