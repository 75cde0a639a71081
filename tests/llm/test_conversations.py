"""Conversation repair against an exhaustive search, and odd turns against a plain Python account of them."""

import hashlib
import random
import re
import zlib

import pytest

from corpusmill.llm import conversation_repair as R


def exhaustive(roles, faults):
    """The least (cost, audit) over every way to edit a few turns."""
    best = (3 * len(roles), "D" * len(roles))

    def go(at, initials, cost, audit):
        nonlocal best
        if cost > best[0]:
            return
        if at == len(roles) and re.fullmatch("(s?(ua)+)?", initials):
            best = min(best, (cost, audit))
        if at < len(roles):
            go(at + 1, initials, cost + 3, audit + "D")
            if faults[at] in (R.SOUND, R.IS_TRUNCATED):
                stay = cost + (faults[at] == R.IS_TRUNCATED)
                go(at + 1, initials + "suax"[roles[at]], stay, audit + "K")
                for to in "ua":
                    go(at + 1, initials + to, stay + 2, audit + "R")
        if audit.count("I") < len(roles) + 3:
            for to in "ua":
                go(at, initials + to, cost + 2, audit + "I")

    go(0, "", 0, "")
    return best


def drawn(rnd, most):
    n = rnd.randint(1, most)
    return [rnd.choice([0, 1, 1, 2, 2, 3]) for _ in range(n)], [rnd.choice([0, 0, 0, 1, 2, 3]) for _ in range(n)]


def test_alignment_finds_the_least_cost_and_audit():
    rnd = random.Random(1)
    for _ in range(400):
        roles, faults = drawn(rnd, 4)
        want = exhaustive(roles, faults)
        assert R.aligned(roles, faults, R.incumbent(roles, faults)) == want == R.folded(roles, faults), (roles, faults)


def test_folded_lengths_agree_with_the_table_on_long_conversations():
    rnd = random.Random(2)
    for _ in range(60):
        roles, faults = drawn(rnd, 80)
        assert R.aligned(roles, faults, R.incumbent(roles, faults)) == R.folded(roles, faults)
    roles, faults = [R.U, R.A] * 4_000, [R.SOUND, R.SOUND, R.IS_TRUNCATED, R.IS_BLANK] * 2_000
    assert R.best_edits(roles, faults)[0] == 2_000 + 2_000 * 3 + 2_000 * 2  # each lost answer comes back empty


def plain(turns, damage=False):
    """Per conversation its row, computed turn by turn: turns are (conv, turn, role, text)."""
    convs, blank = {}, " \t\n\x0b\x0c\r"
    for conv, turn, role, text in turns:
        rows = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20 if damage else 9
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        rows += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, roles, faults = set(), [], []
        for _, role, text in rows:
            ending = text.rstrip(blank)
            fault = R.IS_BLANK if not ending else R.IS_DUPLICATE if (role, text) in seen else R.SOUND
            if fault == R.SOUND and ending[-1] not in ".!?":
                fault = R.IS_TRUNCATED
            seen.add((role, text))
            roles.append({"s": 0, "u": 1, "a": 2}.get(role[:1], 3))
            faults.append(fault)
        cost, audit = exhaustive(roles, faults) if rows else (0, "")
        initials = "".join(role[:1] or "-" for _, role, _ in rows)
        numbers = [t for t, _, _ in rows if t is not None]
        kept, at, due = [], 0, "user"
        for edit in audit:
            if edit == "I":
                kept.append((due, ""))
            else:
                _, role, text = rows[at]
                at += 1
                if edit != "D":
                    kept.append((role if edit == "K" else due, text))
            if edit != "D":
                due = "assistant" if kept[-1][0][0] == "u" else "user"
        out[conv] = (
            len(rows),
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(faults.count(f) for f in (R.IS_BLANK, R.IS_DUPLICATE, R.IS_TRUNCATED)),
            sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1)),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
        )
    return out


MESSY = [
    (1, 0, "user", "Hi?"), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."), (1, 5, "user", "More"),
    (2, None, None, None), (2, 3, "user", "\n\t "), (2, 3, "system", "Rules."), (2, 4, "assistant", "First."),
    (None, 0, "assistant", "No id."), (None, 1, "user", "é😀 \x1c!"),
    (3, 0, "", "role without letters."), (3, 1, "User", "capital."),
    (4, None, "user", "x" * 300_000 + "."), (4, None, "assistant", "y."),
    (5, 7, "tool", ""),
]
SCHEMA = "conv_id long, turn long, role string, text string, gone boolean, nth long, kind string, fault string, damage int"


@pytest.fixture
def turns(spark):
    return spark.createDataFrame([(*row, True, 3, "k", "f", 1) for row in MESSY], SCHEMA)


def test_messy_turns(turns):
    got = {r["conv_id"]: tuple(r)[1:] for r in R.audits(turns).collect()}
    assert got == plain(MESSY)


def test_damaged_turns(spark):
    rows = [(conv, turn, role, f"{conv} says {turn}.") for conv in range(30) for turn, role in enumerate(("user", "assistant", "user", "assistant")[: 1 + conv % 4])]
    rows += [(None, None, "user", "odd."), (77, None, None, None)]
    damaged, gone = R.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: tuple(r)[1:] for r in R.audits(damaged, gone=gone).collect()}
    assert got == plain(rows, damage=True)
    assert {kind for conv, turn, *_ in rows for kind in [zlib.crc32(f"{conv}:{turn}".encode()) % 20]} >= {0, 1, 2, 3, 4}


def test_repaired_turns_are_what_the_digest_covers(turns):
    texts = {}
    for r in sorted(R.repaired_turns(turns).collect(), key=lambda r: r["place"]):
        texts.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    digests = {conv: row[-1] for conv, row in plain(MESSY).items()}
    assert {c: hashlib.sha256("\n".join(texts.get(c, [])).encode()).hexdigest() for c in digests} == digests


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert R.audits(empty).collect() == [] == R.repaired_turns(empty).collect()


def test_large_conversations_wait_in_a_file(monkeypatch):
    monkeypatch.setattr(R, "HELD_BYTES", 50)
    held = R._Turns()
    for n in range(40):
        held.add(n, R.U if n % 2 == 0 else R.A, R.SOUND, "user" if n % 2 == 0 else "assistant", f"text {n}.")
    assert held.file is not None
    assert [text for *_, text in held.repaired("K" * 40)] == [f"text {n}." for n in range(40)]
