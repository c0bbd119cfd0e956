import hashlib
import itertools
import random
import re
import zlib

import pytest

from foliant.llm import structure

SCHEMA = "conv_id long, turn long, role string, text string, key string, fault int, gone string"
LEGAL = re.compile("(s?(ua)+)?")
BLANK = " \t\n\x0b\x0c\r"


def make(spark, rows):
    return spark.createDataFrame([(*r, "k", 7, "g") for r in rows], SCHEMA)


def harm(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        out += [(c, t, "user" if d == 4 else role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        end = text.rstrip(BLANK)[-1:]
        out.append(1 if not end else 2 if (role, text) in seen else 3 if end not in ".!?" else 0)
        seen.add((role, text))
    return out


def edits(role, text, fault):
    yield 4, "D", ""
    if fault in (0, 3):
        more = 3 * (fault == 3)
        yield more, "K", f"{role}:{text}\n"
        for r in ("user", "assistant"):
            yield 3 + more, "R", f"{r}:{text}\n"


def initials(made):
    return made


def exhaustive(rows):
    """The best of all edits with up to three inserts at each place."""
    found = faults(rows)
    inserts = [[("I", r) for r in x] for n in range(4) for x in itertools.product(("user", "assistant"), repeat=n)]
    best = None
    for chosen in itertools.product(*[list(edits(*r, f)) for r, f in zip(rows, found)]):
        for runs in itertools.product(inserts, repeat=len(rows) + 1):
            cost = sum(x[0] for x in chosen) + 3 * sum(map(len, runs))
            if best and cost > best[0]:
                continue
            audit, out, letters = "", [], ""
            for k, run in enumerate(runs):
                audit += "I" * len(run)
                out += [f"{r}:" for _, r in run]
                letters += "".join(r[0] for _, r in run)
                if k < len(rows):
                    _, code, text = chosen[k]
                    audit += code
                    if code != "D":
                        out.append(text[:-1])
                        letters += (rows[k][0] if code == "K" else text)[:1]
            if LEGAL.fullmatch(letters) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, "\n".join(out))
    return best


def by_strings(rows):
    """The same with audit strings kept for each place in the grammar; runs of up to three inserts."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    grow = lambda at, r: step.get((at, r[:1])) if r else at

    def runs(states):
        out = dict(states)
        for at, (cost, audit, made) in states.items():
            for n in range(3):
                r = "assistant" if at == "u" else "user"
                at, cost, audit, made = grow(at, r), cost + 3, audit + "I", made + [f"{r}:"]
                yield at, (cost, audit, made)
        yield from states.items()

    def least(ways):
        out = {}
        for at, w in ways:
            if at is not None and (at not in out or w[:2] < out[at][:2]):
                out[at] = w
        return out

    now = {"": (0, "", [])}
    for (role, text), fault in zip(rows, faults(rows)):
        ways = []
        for at, (cost, audit, made) in runs(now):
            for c, code, line in edits(role, text, fault):
                to = at if code == "D" else grow(at, role if code == "K" else line)
                ways.append((to, (cost + c, audit + code, made + ([] if code == "D" else [line[:-1]]))))
        now = least(ways)
    cost, audit, made = min(w for at, w in runs(now) if at in ("", "a"))
    return cost, audit, "\n".join(made)


def expected(rows, solve=by_strings):
    convs, ids = {}, {r[0] for r in rows}
    for c, t, role, text in harm(rows):
        convs.setdefault(c, []).append((t, role, text))
    out = {}
    for c in ids:
        own = sorted(convs.get(c, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, _, _ in own if t is not None}
        f = faults([r[1:] for r in own])
        bad = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, made = solve([r[1:] for r in own])
        out[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, f.count(1), f.count(2), f.count(3), bad, cost, audit, hashlib.sha256(made.encode()).hexdigest())
    return out


def check(spark, rows, solve=by_strings):
    got = structure.repair(structure.damaged(structure.plain(make(spark, rows)))).collect()
    mine = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got}
    assert len(got) == len(mine) and mine == expected(rows, solve)
    return mine


ROLES, TEXTS = ["user", "assistant", "system", "tool", "", None, "user", "assistant"], ["Yes.", "No!", "cut off", "", " \n", None, "a?\x85", "Why? ", "So. "]


def some(rng, convs, longest, roles=ROLES):
    return [(c if c else None, rng.choice([t, t, t, t // 2, None, t + 3]), rng.choice(roles), rng.choice(TEXTS)) for c in range(convs) for t in range(rng.randint(0, longest))]


def test_small_conversations_against_all_edits():
    rng = random.Random(1)
    for _ in range(60):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Yes.", "cut off", ""])) for _ in range(rng.randint(0, 2))]
        assert exhaustive(rows) == by_strings(rows)


def test_conversations_against_strings(spark):
    check(spark, some(random.Random(2), 300, 14))


def test_conversations_over_many_partitions(spark):
    rng = random.Random(3)
    long_ = [(5, t, rng.choice(ROLES[:4]), f"{t} {rng.choice(['ok.', 'cut', 'ok.'])}" if rng.random() < 0.8 else "Again.") for t in range(1500)]
    own = check(spark, long_ + [(6, t, "assistant", f"a{t}") for t in range(400)] + some(rng, 40, 6) + [(77, 0, "user", "x" * 200_000 + ".")])
    assert len(own[5][6]) >= 1300


def test_long_conversations_of_one_role(spark):
    for role in ("system", "assistant", "tool"):
        check(spark, [(1, t, role, f"{t}.") for t in range(300)])


def test_undamaged_rows_and_none(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "user", "u."), (1, 2, "assistant", "a."), (2, 0, "assistant", "a.")]
    got = {r.conv_id: (r.cost, r.audit, r.n_rows, r.n_repaired) for r in structure.repair(structure.plain(make(spark, rows))).collect()}
    assert got == {1: (0, "KKK", 3, 3), 2: (3, "IK", 1, 2)}
    assert structure.repair(structure.damaged(structure.plain(make(spark, [])))).count() == 0


def test_few_layers_are_ever_worked_out(spark):
    structure._layers.clear()
    run = structure.Run((0, 1, 2, 3))
    rng = random.Random(4)
    for _ in range(50_000):
        run.add((rng.choice("suat "), rng.randrange(4)))
    assert len(structure._layers) < 3000


@pytest.mark.parametrize("cuts", [1, 2, 5])
def test_runs_compose(cuts):
    """A conversation cut anywhere costs as much and ends as when it is whole."""
    rng = random.Random(cuts)
    for _ in range(40):
        kinds = [(rng.choice("suat"), rng.randrange(4)) for _ in range(rng.randint(0, 25))]
        at = sorted(rng.randint(0, len(kinds)) for _ in range(cuts))
        heads = []
        for part, (a, b) in enumerate(zip([0, *at], [*at, len(kinds)])):
            run = structure.Run((0, 1, 2, 3) if part else (0,))
            for k in kinds[a:b]:
                run.add(k)
            heads.append({"key": "v1", "part": part, "ends": run.table(), "run": run})
        ways = structure.bridged(heads)
        codes = b""
        for h in heads:
            start, end, cost = ways["v1", h["part"]]
            codes += structure.way(b"".join(c.to_bytes(4, "little") for c in h["run"].cells[start]), end)[0]
        whole = structure.Run((0,))
        for k in kinds:
            whole.add(k)
        end, best = structure.last(whole.table()[0])
        assert cost == best and codes == structure.way(b"".join(c.to_bytes(4, "little") for c in whole.cells[0]), end)[0]
