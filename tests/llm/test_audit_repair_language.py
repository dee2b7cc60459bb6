"""Source divergence, conversation repair and language identification against brute-force versions, and on odd rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sunfleet.llm import conversation_repair, language_id, queries, source_audit

DOCUMENTS = "doc_id long, text string, lang string, source string, n string, p long, term string, value long"


# ---- source divergence ----

def brute_audit(rows):
    n, d, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = re.findall(rb"[A-Za-z\x80-\xff]+", (text or "").encode())
        found = [w.lower() for w in found]
        n.update((lang, source, w) for w in found)
        d.update((lang, w) for w in set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(w for (x, w), k in d.items() if x == lang and k >= 3)
        sources = sorted(s for x, s in groups if x == lang)
        total = {s: sum(n[lang, s, w] for w in kept) for s in sources}
        whole = sum(total.values())
        chance = lambda c, t: 1 + 10**9 * (c + 1) // (t + len(kept))
        far = lambda p, q: (p - q) ** 2 // q
        for s in sources:
            pairs = [(-sum(far(chance(n[lang, s, w], total[s]), chance(n[lang, o, w], total[o])) for w in kept), o.encode()) for o in sources if o != s]
            over = []
            for w in kept:
                if n[lang, s, w]:
                    p, q = chance(n[lang, s, w], total[s]), chance(sum(n[lang, o, w] for o in sources), whole)
                    if p > q:
                        over.append((-far(p, q), w))
            for part, found in (("pair", sorted(pairs)), ("term", sorted(over)[:200])):
                out += [(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(found, 1)]
    return sorted(out)


def audit_rows():
    r = random.Random(5)
    words = ["".join(r.choices("abcdefgéß", k=r.randint(1, 5))) for _ in range(900)]
    rows = [(None, None, None), ("", "", ""), ("... 12 !?", "xx", "only"), ("A a\x00a", None, "s1"), ("İı Ünï", "yy", None)]
    for k in range(600):
        source = "hot" if k % 3 == 0 else f"s{r.randint(0, 9)}"
        # zipf-like use: many levels of counts for the first words
        rows.append((" ".join(r.choices(words, weights=[1 / (i + 1) for i in range(900)], k=r.randint(1, 150))) + r.choice([".", "\n", " X-Y"]), r.choice(["xx", "xx", "yy", None]), source))
    rows += [rows[-1]] * 4 + [("zz " * 60_000, "xx", "s1")]
    return rows


@pytest.mark.parametrize(("block", "piece"), [(64, 1 << 20), (3, 50)])
def test_audit_equals_brute_force(spark, monkeypatch, block, piece):
    monkeypatch.setattr(source_audit, "BLOCK", block)
    monkeypatch.setattr(source_audit, "PIECE", piece)
    monkeypatch.setattr(source_audit, "HELD", 500)
    rows = audit_rows()
    docs = spark.createDataFrame([(k, t, lang, s, "x", 1, "y", 2) for k, (t, lang, s) in enumerate(rows)], DOCUMENTS).repartition(5)
    got = sorted(tuple(x) for x in source_audit.audit(docs).collect())
    assert got == brute_audit(rows)


def test_audit_of_nothing_and_of_large_counts(spark):
    assert source_audit.audit(spark.createDataFrame([], DOCUMENTS)).count() == 0
    rows = [("w", "l", "a"), ("w", "l", "b"), ("w", "l", "b"), ("rare " + "w " * 3_000_000, "l", "a"), ("rare rare", "l", "b"), ("rare", "l", "c")]
    docs = spark.createDataFrame([(None, t, lang, s, "x", 1, "y", 2) for t, lang, s in rows], DOCUMENTS)
    assert sorted(tuple(x) for x in source_audit.audit(docs).collect()) == brute_audit(rows)


# ---- conversation repair ----

def faults(rows):
    """First fault of every row and its role's initial."""
    out, seen = [], set()
    for role, text in rows:
        marks = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role[:1], fault))
    return out


def brute_repair(rows):
    """(cost, audit, repaired) by trying everything, cheapest first in each state."""
    best = {0: (0, "", ())}
    lead = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}

    def inserted(states):
        states = dict(states)
        for _ in range(4):
            for q, (cost, audit, kept) in list(states.items()):
                for x in "ua":
                    if q in lead[x]:
                        new = (cost + 3, audit + "I", (*kept, ({"u": "user", "a": "assistant"}[x], "")))
                        states[lead[x][q]] = min(states.get(lead[x][q], new), new, key=lambda v: v[:2])
        return states

    for (role, text), (initial, fault) in zip(rows, faults(rows), strict=True):
        after = {}
        for q, (cost, audit, kept) in inserted(best).items():
            moves = [(q, cost + 4, "D", ())]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if q in lead.get(initial, {}):
                    moves.append((lead[initial][q], cost + more, "K", ((role, text),)))
                moves += [(lead[x][q], cost + more + 3, "R", ((name, text),)) for x, name in (("u", "user"), ("a", "assistant")) if q in lead[x]]
            for target, c, letter, new in moves:
                found = (c, audit + letter, (*kept, *new))
                after[target] = min(after.get(target, found), found, key=lambda v: v[:2])
        best = after
    return min((v for q, v in inserted(best).items() if q in (0, 3)), key=lambda v: v[:2])


def all_repairs(rows):
    """The least (cost, audit) over every list of edits with at most two insertions in a row."""
    given = faults(rows)
    best = None
    for letters in itertools.product(("D", "Ku", "K", "Ru", "Ra"), repeat=len(rows)):
        for gaps in itertools.product(("", "u", "a", "ua", "au"), repeat=len(rows) + 1):
            roles, audit, cost = gaps[0], "I" * len(gaps[0]), 3 * len(gaps[0])
            for (initial, fault), x, gap in zip(given, letters, gaps[1:], strict=True):
                if x == "Ku" or (fault in ("blank", "duplicate") and x != "D"):
                    break
                cost += {"D": 4, "K": 0, "R": 3}[x[0]] + (3 if x != "D" and fault == "truncated" else 0) + 3 * len(gap)
                roles += {"D": "", "K": initial, "R": x[1:]}[x[0]] + gap
                audit += x[0] + "I" * len(gap)
            else:
                if re.fullmatch("(s?(ua)+)?", roles):
                    best = min(best or (cost, audit), (cost, audit))
    return best


def brute_lines(rows):
    """Contract columns from (conv_id, turn, role, text)."""
    ids, left = {}, defaultdict(list)
    for conv, turn, role, text in rows:
        ids.setdefault(conv, None)
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            left[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv in ids:
        same = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        turns = sorted(left[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), same(r)))
        numbers = {r[0] for r in turns if r[0] is not None}
        given = [r[1:] for r in turns]
        found = Counter(f for _, f in faults(given))
        initials = [role[:1] for role, _ in given]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, kept = brute_repair(given)
        text = "\n".join(f"{role}:{text}" for role, text in kept)
        out[conv] = (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, found["blank"], found["duplicate"], found["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def test_brute_force_agrees_with_all_edits():
    r = random.Random(2)
    kinds = [(role, text) for role in ("system", "user", "assistant", "tool") for text in ("Yes.", "No", " ", "Well!")]
    for _ in range(25):
        rows = r.choices(kinds, k=r.randint(0, 3))
        assert brute_repair(rows)[:2] == (all_repairs(rows) or (0, ""))


@pytest.mark.parametrize("shortest", [2, 64])
def test_repair_equals_brute_force(spark, monkeypatch, shortest):
    r = random.Random(shortest)
    texts = ["Yes.", "No", "Well!", "é? ", " \n\t", "", None, "a. \r\n", "b\x0b", "Why? " * 40]
    rows = [(None, None, None, None), (7, None, "user", "x."), (8, 5, "user", "hi."), (8, -3, "assistant", "so.")]
    for conv in [*range(100, 240), None]:
        for turn in range(r.randint(0, 9)):
            rows.append((conv, r.choice([turn, turn, turn, None, 3]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), r.choice(texts) if r.random() < 0.4 else f"t{r.random()}."))
    for turn in range(900):  # a third of all rows
        rows.append((1, turn // 2 if turn < 400 else turn, "user" if turn % 2 else "assistant", r.choice(texts) if r.random() < 0.2 else f"t{turn}."))
    rows += rows[5:60]
    frame = spark.createDataFrame([(*row, "x", 1) for row in rows], "conv_id long, turn long, role string, text string, conv string, at long").repartition(7)
    kept = conversation_repair.repair
    monkeypatch.setattr(conversation_repair, "repair", lambda f: kept(f, shortest))
    got = {x[0]: tuple(x)[1:] for x in conversation_repair.report(frame, conversation_repair.damaged(frame)).collect()}
    want = brute_lines(rows)
    assert {k: v for k, v in got.items() if want.get(k) != v} == {}
    assert got == want


def test_repair_of_nothing(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_repair.report(frame, frame).count() == 0


# ---- language ----

def test_subwords_are_the_strings_inside_words():
    def plain(piece):
        return sum(1 for n in (2, 3, 4) for i in range(len(piece) - n + 1) if b" " not in piece[i + 1:i + n - 1])

    for piece in (b" a ", b" ab cde ", " grün über ".encode(), b" x yz abcdefg hi "):
        assert len(language_id.subwords(piece)) == plain(piece)
    word = bytes(random.Random(1).choices(b"abcdef", k=500))
    whole = language_id.subwords(word)
    parts = np.concatenate([language_id.subwords(word[k:k + 63], 60) for k in range(0, 500, 60)])
    assert sorted(whole) == sorted(parts)


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op13_language_id(spark, sf).collect()
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(got) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    judged = [r for r in got if r["held_out"] and truth[r["doc_id"]][0]]
    right = [r["lang_pred"] == truth[r["doc_id"]][0] for r in judged]
    sure = [x for x, r in zip(right, judged, strict=True) if not r["rejected"]]
    assert np.mean(right) > 0.97
    assert np.mean(sure) > 0.98 and len(sure) > 0.8 * len(judged)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_languages_of_odd_rows(spark):
    rows = [(k, f"{'der die und' if k % 2 else 'le la et'} {chr(97 + k % 7) * 3}", "de" if k % 2 else "fr", "s", "x", 1, "y", 2) for k in range(400)]
    odd = [None, "", " \n ", "12 34 !", "²①", "ж", "der", "xyz" * 400_000, "der " * 200_000]
    rows += [(1000 + k, t, None, None, "x", 1, "y", 2) for k, t in enumerate(odd)] + [(None, "le la et", "fr", None, "x", 1, "y", 2)] * 3
    docs = spark.createDataFrame(rows, DOCUMENTS)
    got = language_id.predictions(docs).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert [by_id[1000 + k]["lang_pred"] for k in range(5)] == ["und"] * 5
    assert {by_id[1000 + k]["lang_pred"] for k in range(5, 9)} <= {"de", "fr"}
    assert by_id[1006]["lang_pred"] == by_id[1008]["lang_pred"] == "de"
    nameless = [r for r in got if r["doc_id"] is None]
    assert len(nameless) == 3 and {(r["held_out"], r["lang_pred"]) for r in nameless} == {(False, "fr")}
    assert language_id.predictions(docs.filter("false")).count() == 0
    untaught = language_id.predictions(docs.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()
    assert {(r["lang_pred"], r["score"]) for r in untaught} == {("und", 0.0)}


def test_languages_do_not_depend_on_the_layout(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    runs = [sorted((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in language_id.predictions(docs.repartition(n)).collect()) for n in (1, 5)]
    assert runs[0] == runs[1]
