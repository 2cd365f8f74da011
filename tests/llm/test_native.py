"""op3, op6, op8, op10: against plain Python, with nulls, repeats, long texts, empty tables and clashing columns."""

import hashlib
import random
import re
from collections import Counter

import pytest

from qaloom.llm import chat, decontam, line_dedup, secret_scan

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KIND = "doc_id long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows, kind=KIND):
    return spark.createDataFrame(rows, kind)


def counted(df):
    return Counter(tuple(map(str, r)) for r in df.collect())


def texts(seed=1):
    rng = random.Random(seed)
    lines = ["Common LINE ", "\tcommon line", "É lower", "é lower", "", "   ", "a", "b c", "x\x1cy", "rare %d"]
    rows = [(i, "\n".join(rng.choice(lines).replace("%d", str(i)) for _ in range(rng.randrange(0, 9)))) for i in range(40)]
    return [*rows, (None, None), (None, "a\ncommon line"), (7, ""), (7, ""), (8, "z" * 200_000 + "\ncommon line\n" + "q\n" * 3000)]


def test_line_dedup(spark):
    rows = texts()
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    often = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    want = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or often[key(x)] < 10]
        want[str(i), str(len(lines)), str(len(lines) - len(kept)), sha("\n".join(kept))] += 1
    assert counted(line_dedup.query(frame(spark, rows))) == want
    assert line_dedup.query(frame(spark, [])).count() == 0
    clash = frame(spark, [(i, t, "k", 1) for i, t in rows], KIND + ", _k1 string, n_lines int")
    out = line_dedup.drop_common_lines(clash)
    assert out.columns == ["doc_id", "text", "_k1", "n_lines", "n_dropped"] and out.count() == len(rows)


def hits(text, items, window=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(FOLD))
    w, spots, found = cut(text), set(), set()
    for item, t in items:
        v = cut(t)
        n = min(window, len(v))
        grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in grams:
                spots |= set(range(i, i + n))
                found.add("" if item is None else str(item))
    return len(w), spots, sorted(found)


def bench_rows():
    base = " ".join(f"w{i}" for i in range(25))
    return [(1, base), (2, "One two, THREE"), (3, None), (4, ""), (10, base), (None, "lonely"), (5, "é É x")]


def doc_rows():
    base = " ".join(f"w{i}" for i in range(25))
    return [
        (1, "before " + base.upper() + " after"), (2, "x one TWO three one two three"), (3, None), (4, ""), (None, "so lonely here"), (5, base[:40]), (5, base[:40]), (6, " ".join(["w0"] * 5000 + [base] * 40)), (7, "é É x!"), (8, "clean text"),
    ]


def test_decontaminate(spark):
    docs, items = frame(spark, doc_rows()), frame(spark, bench_rows(), "item_id long, text string")
    want = Counter()
    for i, t in doc_rows():
        n, spots, found = hits(t, bench_rows())
        want[tuple(map(str, (i, n, len(spots), len(found), sha(",".join(found)), bool(spots))))] += 1
    assert counted(decontam.query(docs, items)) == want
    assert decontam.query(docs.limit(0), items).count() == 0
    assert {r["n_hit"] for r in decontam.query(docs, items.limit(0)).collect()} == {0}
    clash = frame(spark, [(i, t, "x", 1) for i, t in doc_rows()], KIND + ", item_id string, gram int")
    kept = decontam.remove_documents(clash, items)
    assert kept.columns == clash.columns and sorted(str(r[0]) for r in kept.collect()) == sorted(str(i) for i, t in doc_rows() if not hits(t, bench_rows())[1])
    spans = {r["doc_id"]: r["text"] for r in decontam.remove_spans(docs, items).collect()}
    assert spans[2] == "x " and spans[8] == "clean text" and spans[1] == "before after"


def test_decontaminate_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    test_decontaminate(spark)


def spans(text):
    out = []
    stated = [secret_scan.RULES[0], secret_scan.Rule("access", "AKIA[A-Z0-9]+", 0, 20), secret_scan.Rule("hex", "[0-9a-f]+", 0, 24), *secret_scan.RULES[3:]]
    for k, r in enumerate(stated):
        out += [(m.start(), k, m.end()) for m in re.finditer(r.pattern, text or "") if len(m[r.group]) >= r.least]
    return ",".join(f"{secret_scan.RULES[k].kind}:{a}:{b}" for a, k, b in sorted(out))


def secret_rows():
    rng = random.Random(3)
    parts = ["password=hunter22", "PassWD: 'abc12'", "token=token=abcdef", "secret:token :abcdefgh", "api_key = \"A/b+c=d.e\"", "apikey:x", "AKIA" + "Z9" * 8, "AKIAAKIA" + "B" * 13, "AKIA123", "deadbeef" * 3, "0" * 30, "é😀", " ", "\n", "g"]
    parts += ["-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 18, "eyJ" + "a" * 9 + ".eyJ" + "b" * 9 + "." + "c" * 9]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 8)))) for i in range(120)]
    return [*rows, (None, None), (None, "token=abcdef"), (3, ""), (3, ""), (4, "é" * 100_000 + "password=hunter22" + " deadbeef" * 2000)]


def test_secret_scan(spark):
    rows = secret_rows()
    got = Counter((str(r["doc_id"]), r["spans"]) for r in secret_scan.query(frame(spark, rows)).collect())
    assert got == Counter((str(i), spans(t)) for i, t in rows)
    assert secret_scan.query(frame(spark, [])).count() == 0
    clash = frame(spark, [(i, t, 1) for i, t in rows], KIND + ", spans int")
    assert secret_scan.scan(clash).columns == ["doc_id", "spans"]


@pytest.mark.parametrize("rule", secret_scan.RULES, ids=lambda r: r.kind)
def test_trigram_queries_never_lose_a_match(rule):
    ways = secret_scan.trigram_query(rule.pattern)
    assert (frozenset() in ways) == (rule.kind == "hex")
    for _, t in secret_rows():
        if re.search(rule.pattern, t or ""):
            low = t.translate(FOLD)
            assert any(all(g in low for g in way) for way in ways)
    assert secret_scan.trigram_query("ab") == frozenset([frozenset()]) and secret_scan.trigram_query("abc(d|ef)?x*") == frozenset([frozenset(["abc"])])


EVENTS = "conv_id long, msg long, turn long, seq long, kind string, role string, text string"


def test_fold_events(spark):
    log = [
        (1, 1, 0, 1, "message", "user", "Hi"), (1, 1, 0, 1, "message", "user", "Hi"), (1, 2, 1, 2, "message", "assistant", ""), (1, 2, None, 3, "delta", None, "wro"), (1, 2, None, 4, "delta", None, "ng"), (1, 2, None, 5, "regenerate", None, None),
        (1, 2, None, 6, "delta", None, "right"), (1, 2, None, 7, "delta", None, " now"), (1, 1, None, 8, "edit", None, "Hello"), (1, 3, 2, 9, "message", "user", "x"), (1, 3, None, 10, "delete", None, None), (2, 1, 0, 1, "delta", "assistant", None), (None, None, None, None, None, None, None),
    ]
    got = {(r["conv_id"], r["msg"]): (r["turn"], r["role"], r["text"]) for r in chat.fold(frame(spark, log, EVENTS)).collect()}
    assert got == {(1, 1): (0, "user", "Hello"), (1, 2): (1, "assistant", "right now"), (2, 1): (0, "assistant", ""), (None, None): (None, None, "")}
    assert chat.format_log(frame(spark, [], EVENTS)).count() == 0


def test_chat_round_trip(spark):
    rng = random.Random(5)
    bits = ["</s>", "<\\/s>", "<s>", "[INST]", "[\\INST]", "[/INST]", "<", "[", "\\", "s>", "/s>", "é", "\n", "x", "INST]"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "</s>", None]), rng.choice([None, "".join(rng.choice(bits) for _ in range(rng.randrange(12)))])) for c in range(30) for t in range(rng.randrange(1, 6))]
    rows += [(5, 0, "user", "same"), (5, 0, "user", "same"), (None, 1, "assistant", "long " * 50_000)]
    df = frame(spark, rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.query(spark, df).collect()}
    want = {}
    for c, t, role, text in [*rows, (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]:
        want.setdefault(c, []).append((t, role is not None, role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        turns.sort()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        r = got[c]
        assert (r["n_turns"], r["loss_chars"], r["loss_sha256"]) == (len(turns), len(loss), sha(loss))
        if len({t for t, *_ in turns}) == len(turns):
            assert r["turns_sha256"] == sha("".join(f"{role}\n{x}\n" for _, _, role, x in turns))
