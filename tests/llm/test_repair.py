import hashlib
import random
import re
import zlib

import pytest

from flowtide.llm import repair

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def spoiled(rows):
    out = []
    for conv, turn, role, text in rows:
        rule = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if rule == 0:
            continue
        text = "" if rule == 1 else re.sub("[.!?]", "", text) if rule == 2 else text
        out += [(conv, turn, "user" if rule == 4 else role, text)] * (2 if rule == 3 else 1)
    return out


def brute(rows):
    """One conversation: all edits, state by state, with whole audits."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults, kinds = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
    for _, _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        kind = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        kinds.append(kind)
        if kind:
            faults[kind] += 1
    best = {"": (0, "", [])}  # what the pattern has so far: "", s, u, a

    def follow(state):
        return "a" if state == "u" else "u"

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, text) in list(best.items()):
                to = follow(state)
                name = "user:" if to == "u" else "assistant:"
                new = (cost + 3, audit + "I", [*text, name])
                if to not in best or new[:2] < best[to][:2]:
                    best[to] = new
        return best

    best = inserted(best)
    for (_, _, role, text), kind in zip(rows, kinds, strict=True):
        after = {}
        for state, (cost, audit, made) in best.items():
            options = [(state, (cost + 4, audit + "D", made))]
            if kind not in ("blank", "duplicate"):
                extra = 3 if kind == "truncated" else 0
                to = follow(state)
                name = "user" if to == "u" else "assistant"
                options.append((to, (cost + 3 + extra, audit + "R", [*made, f"{name}:{text}"])))
                if role[:1] == to or (role[:1] == "s" and state == ""):
                    options.append((role[:1], (cost + extra, audit + "K", [*made, f"{role}:{text}"])))
            for to, new in options:
                if to not in after or new[:2] < after[to][:2]:
                    after[to] = new
        best = inserted(after)
    cost, audit, made = min((best[s] for s in ("", "a") if s in best), key=lambda b: b[:2])
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    return (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())


def expected(rows, all_rows):
    groups = {r[0]: [] for r in all_rows}
    for r in rows:
        groups[r[0]].append(r)
    return {c: brute(g) for c, g in groups.items()}


def random_rows(seed, conversations, longest):
    pick = random.Random(seed)
    texts = ["Yes.", "no", "Why?", "", " \n", "what ever", "Go!  ", "日本。", "a.b"]
    out = []
    for c in range(conversations):
        turn = pick.randrange(3)
        for _ in range(pick.randrange(longest)):
            out.append((c, turn, pick.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]), pick.choice(texts) + pick.choice(["", str(turn) + "."])))
            turn += pick.choice([0, 1, 1, 1, 2])
    return out


def table(spark, rows):
    schema = "conv_id bigint, turn bigint, role string, text string, pos string, `a.b` int, audit int"
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], schema)


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.select(*COLUMNS).collect()}


@pytest.mark.parametrize("seed,count,longest,bits", [(1, 120, 9, 12), (2, 25, 90, 3), (3, 40, 30, 1)])
def test_report_equals_brute_force(spark, seed, count, longest, bits):
    """With few bits a conversation is cut into many slices, whose matrices are chained."""
    rows = random_rows(seed, count, longest)
    rows += [(None, None, None, None), (None, 4, "user", "x."), (900, 0, "user", "hi."), (900, 0, "user", "hi."), (900, None, "assistant", "b.")]
    frame = table(spark, rows)
    assert got(repair.repair_report(frame, frame, bits)) == expected([(c, t, r or " ", x or ("" if x == "" else " ")) for c, t, r, x in rows], rows)


def test_damage_follows_the_rule_and_lost_conversations_stay(spark):
    rows = random_rows(5, 150, 6) + [(None, None, None, "t."), (None, 1, "user", None)]
    rows += [(c, 0, "user", "only.") for c in range(1000, 1100)]
    frame = table(spark, rows)
    want = expected(spoiled(rows), rows)
    assert got(repair.repair_report(repair.damaged(frame), frame)) == want
    assert any(v[6] == "" and v[5] == 0 for c, v in want.items() if c is not None and c >= 1000)


def test_repaired_turns_are_the_hashed_ones(spark):
    rows = random_rows(7, 30, 20)
    frame = table(spark, rows)
    lines = {}
    for r in sorted(repair.repaired_turns(frame).collect(), key=lambda r: (r.conv_id, r.place)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, report in got(repair.repair_report(frame)).items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == report[-1]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines.get(conv, [])))


def test_empty_table_and_one_long_text(spark):
    frame = table(spark, [])
    assert repair.repair_report(frame, frame).count() == 0 and repair.repaired_turns(frame).count() == 0
    long = "word " * 400_000 + "."
    report = got(repair.repair_report(table(spark, [(1, 0, "user", long), (1, 1, "assistant", long)])))
    assert report[1][5:7] == (0, "KK")


def test_ropes_and_rules():
    parts = ["D", "I", "K", "R", "DD", "KI", ""]
    pick = random.Random(0)
    made = [repair.Rope(p) for p in parts]
    for _ in range(60):
        made.append(repair.joined(pick.choice(made), pick.choice(made)))
    for x in made:
        for y in made:
            assert repair.less(x, y) == (str(x) < str(y))
    assert repair.pair_counts("aaab") == {"aa": 1, "ab": 1}
    rules = [("ua", ""), ("", "")]
    matrices = repair.rule_matrices(rules)
    plain = repair.rule_matrices([])
    for seq in ("uauauax", "sUAuaua", "aaxxuo"):
        one = repair.evaluate(seq, rules, matrices, repair._identity())
        two = repair.evaluate(seq, [], plain, repair._identity())
        assert [[e and (e[0], str(e[1])) for e in row] for row in one] == [[e and (e[0], str(e[1])) for e in row] for row in two]
