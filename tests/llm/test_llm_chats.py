"""Chat formatting, structure repair and source divergence against plain versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

CHAT = "conv_id long, turn long, role string, text string, `part` string, seq int, `now` string"
TEXTS = ["Hello there.", "ok", "", " ", "Why?", "a <turn user> b </turn>\n c", "\\### Assistant: </turn> ok", "<\\/turn", "x" * 900 + ".",
         "two\nlines!", None, "\\", "</turn", "é😀."]


def chats(seed=3, n=40):
    """Awkward conversations: nulls, ties, repeated rows, odd roles, clashing columns."""
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.choice([1, 1, 2, 4, 6, 9, 30 if c == 5 else 3])):
            rows.append((c, t if r.random() < 0.9 else r.choice([None, 0, 1]), r.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "a>\n<b\\"]),
                         r.choice(TEXTS), "p", 1, None))
    rows += [rows[0], rows[0], rows[3], (None, 1, "user", "x.", None, None, None), (None, None, None, None, None, None, None), (-3, None, "user", "q?", "p", 1, "n"),
             (500, 0, "system", "s.", "p", 1, "n"), (501, 3, "user", "q?", "p", 1, "n"), (501, 9, "assistant", "a.", "p", 1, "n")]
    rows += [(600, 5, "user", "same.", "p", 1, "n")] * 40 + [(601, t, "user", "all the same.", "p", 1, "n") for t in range(40)]
    return rows


def by_conversation(rows, blank):
    out = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        out[conv].append((turn is not None, turn or 0, blank if role is None else role, blank if text is None else text, turn))
    return {c: [(x[4], x[2], x[3]) for x in sorted(v, key=lambda x: x[:2] + (x[2].encode(), x[3].encode()))] for c, v in out.items()}


# ------------------------------------------------------------------ chat formatting

@settings(max_examples=200, deadline=None)
@given(st.text("\\</>turn gl\n", max_size=30), st.text("\\</>turn gl\n", max_size=12))
def test_template_round_trip(text, role):
    from simpairs.llm import chat

    turn, start, length = chat.render(role, text)
    assert chat.parse(turn + turn) == [(role, text)] * 2
    assert chat.unescape(turn[start:start + length]) == text
    assert "</turn" not in chat.escape(text) and "<turn" not in chat.escape(text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("piece", [1 << 22, 50])
def test_chat_format(spark, piece):
    from simpairs.llm import chat

    rows = chats()
    df = spark.createDataFrame(rows, CHAT).repartition(3)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chat.format_chats(chat.as_events(df, step=7), piece)).collect()}
    want = {}
    for c, turns in by_conversation(rows, "").items():
        loss = "".join(text for _, role, text in turns if role == "assistant")
        want[c] = (len(turns), sha("".join(f"{role}\n{text}\n" for _, role, text in turns)), len(loss), sha(loss))
    assert got == want
    assert chat.format_chats(chat.as_events(df.limit(0))).count() == 0


def test_log_folding(spark):
    from simpairs.llm import chat

    log = [(1, "m", 1, "open", "user", None), (1, "m", 2, "delta", None, "a"), (1, "m", 2, "delta", None, "a"), (1, "m", 3, "delta", None, "b"),
           (1, "n", 4, "open", "assistant", None), (1, "n", 5, "delta", None, "draft"), (1, "n", 7, "regenerate", None, None),
           (1, "n", 8, "delta", None, "fi"), (1, "m", 9, "edit", None, "c"), (1, "n", 10, "delta", None, "nal"), (1, "m", 11, "delta", None, "d"),
           (1, "x", 12, "open", "user", None), (1, "x", 13, "delta", None, "gone"), (1, "x", 14, "delete", None, None),
           (2, "y", 5, "delta", None, "no opening"), (None, "z", 1, "open", None, "null id"),
           (3, "w", 1, "open", "user", "t"), (3, "w", 2, "delete", None, None), (3, "w", 3, "regenerate", None, "back")]
    random.Random(1).shuffle(log)
    df = spark.createDataFrame(log, "conv_id long, message string, seq long, kind string, role string, text string").repartition(3)
    got = sorted(map(tuple, chat.messages(df).collect()), key=str)
    assert got == sorted([(1, 1, "user", "cd"), (1, 4, "assistant", "final"), (2, 5, "", "no opening"), (None, 1, "", "null id"),
                          (3, 1, "user", "back")], key=str)
    bad = df.selectExpr("conv_id", "message", "seq", "'what' AS kind", "role", "text")
    with pytest.raises(Exception, match="unknown kind"):
        chat.messages(bad).collect()


# ------------------------------------------------------------------ structure repair

def faults_of(turns):
    seen, out = set(), []
    for _, role, text in turns:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text):
            out.append("truncated")
        else:
            out.append("")
        seen.add((role, text))
    return out


def exhaustive(turns, faults):
    """The least (cost, audit, lines) of all edits with at most two insertions at each boundary."""
    inserts = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    best = None
    for edits in itertools.product(*([("D", None), ("K", role), ("R", "user"), ("R", "assistant")] for _, role, _ in turns)):
        if any(e != "D" and f in ("blank", "duplicate") for (e, _), f in zip(edits, faults)):
            continue
        for more in itertools.product(inserts, repeat=len(turns) + 1):
            cost, audit, lines = 0, "", []
            for (e, role), (_, _, text), f, before in zip(edits, turns, faults, more):
                cost += 5 * len(before) + {"D": 2, "K": 0, "R": 1}[e] + 5 * (e != "D" and f == "truncated")
                audit += "I" * len(before) + e
                lines += [(r, "") for r in before] + ([(role, text)] if e != "D" else [])
            cost, audit, lines = cost + 5 * len(more[-1]), audit + "I" * len(more[-1]), lines + [(r, "") for r in more[-1]]
            if all(r for r, _ in lines) and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in lines)):
                found = (cost, audit, "\n".join(f"{r}:{t}" for r, t in lines))
                best = found if best is None or found < best else best
    return best


def by_rows(turns, faults):
    """The same row by row: the least (cost, audit, lines) at each place."""
    step = {("b", "s"): "s", ("b", "u"): "u", ("s", "u"): "u", ("f", "u"): "u", ("u", "f"): "a"}
    name = {"u": "user", "a": "assistant"}

    def close(places):
        out = dict(places)
        for _ in range(2):
            for (p, q), t in step.items():
                if p in out and t != "s":
                    c, a, lines = out[p]
                    way = (c + 5, a + "I", [*lines, f"{name[t]}:"])
                    out[q] = min(out.get(q, way), way)
        return out

    now = close({"b": (0, "", [])})
    for (_, role, text), f in zip(turns, faults):
        after = {p: (c + 2, a + "D", lines) for p, (c, a, lines) in now.items()}
        more = 5 * (f == "truncated")
        for (p, q), t in step.items():
            if p in now and f not in ("blank", "duplicate"):
                c, a, lines = now[p]
                ways = [(c + more, a + "K", [*lines, f"{role}:{text}"])] if role[:1] == t else []
                ways += [(c + 1 + more, a + "R", [*lines, f"{name[t]}:{text}"])] if t != "s" else []
                for way in ways:
                    after[q] = min(after.get(q, way), way)
        now = close(after)
    cost, audit, lines = min(now[q] for q in "bf" if q in now)
    return cost, audit, "\n".join(lines)


def test_cells_equal_all_edits():
    from simpairs.llm import repair

    r = random.Random(5)
    for k in range(60):
        turns = [(i, r.choice(["user", "assistant", "system", "tool"]), r.choice(["a.", "b", "", f"c{i}."])) for i in range(k % 4)]
        faults = faults_of(turns)
        want = exhaustive(turns, faults)
        assert by_rows(turns, faults) == want
        if not turns:
            continue
        leaves = [repair.leaf(role[:1], f in ("blank", "duplicate"), f == "truncated") for (_, role, _), f in zip(turns, faults)]
        cell = repair.parsed(leaves)
        assert min(cell[x] for x in ("bb", "bf") if x in cell) == want[:2]
    # any split gives the cell of the whole chart; deletions in one go are single deletions
    leaves = [repair.leaf(r.choice("uast"), r.random() < 0.2, r.random() < 0.3) for _ in range(12)]
    whole = repair.parsed(leaves)
    for k in range(1, 12):
        assert repair.combined(repair.parsed(leaves[:k]), repair.parsed(leaves[k:])) == whole
    assert repair.deleted(5) == repair.parsed([repair.leaf("u", True, False)] * 5)


@pytest.mark.parametrize("parts", [1, 7])
def test_structure_repair(spark, parts):
    from simpairs.llm import repair

    rows = chats()
    df = spark.createDataFrame(rows, CHAT)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # conversations are cut over tasks
    try:
        report, turns = repair.repair(df)
        report = {r.conv_id: tuple(r)[1:] for r in report.collect()}
        digests = {r.conv_id: r.repaired_sha256 for r in repair.line_digests(turns).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    conversations = by_conversation(rows, " ")
    assert set(report) == set(conversations)
    for conv, turns in conversations.items():
        faults = faults_of(turns)
        cost, audit, lines = by_rows(turns, faults)
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        n = Counter(faults)
        assert report[conv] == (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit), conv
        assert digests.get(conv, sha("")) == sha(lines)


def test_structure_repair_empty(spark):
    from simpairs.llm import repair

    report, turns = repair.repair(spark.createDataFrame([], CHAT))
    assert report.count() == 0 and turns.count() == 0


def test_damage(spark):
    from simpairs.llm import repair

    rows = chats()
    want = Counter()
    for conv, turn, role, text, *_ in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want[conv, turn, "user" if kind == 4 else role, text] += {0: 0, 3: 2}.get(kind, 1)
    got = Counter(map(tuple, repair.damaged(spark.createDataFrame(rows, CHAT)).collect()))
    assert got == +want


# ------------------------------------------------------------------ source divergence

def test_perfect_hash():
    import numpy as np
    from simpairs.llm import divergence as dv

    terms = [f"w{i}é".encode() for i in range(5000)]
    shard = dv.shard_of(dv.term_hashes(terms), 3)
    shards = {k: dv.PerfectHash.build([terms[i] for i in np.flatnonzero(shard == k)]) for k in (0, 2)}
    lookup = dv.Lookup({k: dv.PerfectHash.unpacked(*m.packed()) for k, m in shards.items()}, 3)
    at = lookup.slots(terms)
    assert ((at < 0) == (shard == 1)).all()
    assert sorted(at[at >= 0].tolist()) == list(range(lookup.n)) and lookup.n == int((shard != 1).sum())
    # terms that are not kept get no slot, whatever place they fall on
    assert (lookup.slots([f"x{i}".encode() for i in range(5000)]) == -1).all()
    # terms that no level tells apart are found in the list of the rest
    levels, dv.LEVELS = dv.LEVELS, 1
    try:
        few = dv.Lookup({0: dv.PerfectHash.build(terms[:300])}, 1)
        assert few.rest and sorted(few.slots(terms[:300]).tolist()) == list(range(300))
    finally:
        dv.LEVELS = levels


def test_shares_are_exact():
    import numpy as np
    from simpairs.llm import divergence as dv

    r = random.Random(2)
    for _ in range(300):
        d = r.randrange(1, 10 ** r.randrange(1, 15))
        c = [r.randrange(0, d) for _ in range(4)] + [0, d - 1]
        assert dv.shares(np.array(c), d).tolist() == [1 + 10**9 * (x + 1) // d for x in c]


def plain_audit(rows, min_docs, top):
    docs = [(lang or "", source or "", [t.translate({k: k + 32 for k in range(65, 91)}) for t in
                                        re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for text, lang, source in rows]
    df, n = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        df[lang].update(set(terms))
        n[lang, source].update(terms)
    out = []
    for lang in df:
        kept = [t for t, k in df[lang].items() if k >= min_docs]
        groups = [s for l, s in n if l == lang]

        def shares(counter):
            total = sum(counter[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counter[t] + 1) // total for t in kept}

        p = {s: shares(n[lang, s]) for s in groups}
        q = shares(sum((n[lang, s] for s in groups), Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for s in groups:
            pair = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s)
            term = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if n[lang, s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pair)]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(term)]
    return Counter(out)


@pytest.mark.parametrize("settings", [{}, {"round_bytes": 300, "shard_terms": 8}])
def test_source_divergence(spark, settings, monkeypatch):
    import llm_brute as brute
    from simpairs.llm import divergence as dv

    r = random.Random(4)
    vocabulary = ["Able", "bÄker", "coal2delta", "echo", "é", "日本", "AZ[az]", "x" * 50, "zulu"] + [f"t{chr(97 + i)}" for i in range(20)]
    rows = [(i, " ".join(r.choices(vocabulary, k=r.randint(0, 40))), r.choice(["en", "en", "de", None]), f"s{r.randint(0, 40) if i % 3 else 1}") for i in range(150)]
    rows += [(900, None, "en", "empty"), (901, "", "fr", "a"), (902, "12 !", "fr", None), (903, "once", "fr", "b"), (904, "lonely", "xx", "one"),
             (None, "echo echo Echo", None, None), (None, "echo echo Echo", None, None)]
    rows = [(*x, 0, 1, "k", 2, None) for x in rows] + brute.awkward_documents(n=10)
    docs = spark.createDataFrame(rows, brute.SCHEMA).repartition(4)
    got = Counter(map(tuple, dv.audit(docs, top=7, **settings).collect()))
    assert got == plain_audit([(x[1], x[2], x[3]) for x in rows], 3, 7)
    assert dv.audit(docs.limit(0)).count() == 0


def test_source_divergence_in_small_steps(spark, monkeypatch):
    """Blocks, held terms and held slots far below their sizes change nothing."""
    from simpairs.llm import divergence as dv

    r = random.Random(6)
    texts = [(" ".join(r.choices([f"a{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)], k=200)), r.choice("xy"), r.choice("abc")) for _ in range(30)]
    for name, value in (("HELD_TERMS", 50), ("HELD_SLOTS", 60), ("HELD_TOKENS", 500), ("TEXT_BLOCK", 100)):
        monkeypatch.setattr(dv, name, value)

    class Value:
        pass

    broadcast = Value()
    import pyarrow as pa

    terms = sorted({t.encode() for text, _, _ in texts for t in text.split()})
    made = dv.PerfectHash.build(terms)
    broadcast.value = [("x", 1, 0, made.packed()), ("y", 1, 0, made.packed())]
    batch = pa.RecordBatch.from_pylist([{"lang": l, "source": s, "text": t} for t, l, s in texts])
    slots = dict(zip(dv.Lookup({0: made}, 1).slots(terms).tolist(), terms))
    got = Counter()
    for out in dv._slot_counter(broadcast)(iter([batch])):
        for row in out.to_pylist():
            for s, n in zip(row["slots"], row["counts"]):
                got[row["lang"], row["source"], slots[s]] += n
    want = Counter((l, s, w.encode()) for t, l, s in texts for w in t.split())
    assert got == want
    counts = Counter()
    for out in dv._document_counts(iter([batch])):
        for row in out.to_pylist():
            counts[row["lang"], row["term"]] += row["n"]
    assert counts == Counter((l, w.encode()) for t, l, _ in texts for w in set(t.split()))
