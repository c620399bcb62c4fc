"""Phrase dedup, spelling groups and conversation repair beside brute force, on tables and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from bitexture.llm import phrase_dedup, queries
from bitexture.llm.conversation_repair import conversation_digests, damaged_conversations, repair_conversations
from bitexture.llm.phrase_dedup import dedupe_phrases
from bitexture.llm.spelling_groups import buckets, spelling_groups, vocabulary

SMALL = "/root/testdata/sf0.001"
BLANK = "\t\n\x0b\x0c\r "


# Phrases


def deduped(rows, width=13):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    owner = {}
    for i, ws in words:
        if i is not None:
            for k in range(len(ws) - width + 1):
                window = tuple(ws[k : k + width])
                owner[window] = min(owner.get(window, i), i)
    out = []
    for i, ws in words:
        gone = set()
        for k in range(len(ws) - width + 1):
            if i is not None and owner[tuple(ws[k : k + width])] < i:
                gone.update(range(k, k + width))
        kept = b" ".join(w for k, w in enumerate(ws) if k not in gone).decode()
        out.append((i, len(ws), len(gone), kept))
    return sorted(out, key=str)


def phrase_rows(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(300)}"
    passages = [[word() for _ in range(rng.randrange(13, 60))] for _ in range(5)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rng.randrange(4)):
            text += [word() for _ in range(rng.randrange(25))]
            if rng.random() < 0.6:
                part = rng.choice(passages)
                text += part[rng.randrange(5) : len(part) - rng.randrange(5)]
        rows.append((rng.randrange(100), rng.choice([" ", "\n", " \t"]).join(text)))
    loop = " ".join(["again and"] * 40)  # overlaps itself
    once = " ".join(word() for _ in range(40))
    rows += [(1, loop), (2, loop + " more"), (500, once), (501, once), (501, once), (None, once), (None, None), (3, None), (4, "")]
    rows += [(502, once + " tail of another text"), (502, once)]
    rows += [(600, "x" * 200_000 + " " + once), (601, " ".join(f"Ü{i} ok" for i in range(20_000))), (602, " ".join(f"Ü{i} ok" for i in range(3, 50)))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("crowd", [phrase_dedup.CROWD, 3])
def test_phrases_against_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(phrase_dedup, "CROWD", crowd)  # with 3, common anchors send windows one by one
    rows = phrase_rows(crowd)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = dedupe_phrases(docs.withColumn("n_words", F.lit("x")))
    assert got.columns == ["doc_id", "text", "n_words", "_n_words", "n_removed"]
    found = sorted(((r.doc_id, r["_n_words"], r.n_removed, r.text) for r in got.collect()), key=str)
    assert found == deduped(rows)
    assert any(r[2] for r in found)


def test_phrases_of_an_empty_table(spark):
    assert dedupe_phrases(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_full_shards_start_anew(spark, monkeypatch):
    monkeypatch.setattr(phrase_dedup, "SHARD_PHRASES", 5)
    rows = phrase_rows(9)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in dedupe_phrases(docs).collect()), key=str)
    assert found == deduped(rows)


# Spelling


def grouped(counts, ratio=2):
    words = list(counts)

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    neighbours = defaultdict(list)
    for i, a in enumerate(words):
        for b in words[:i]:
            if near(a, b):
                neighbours[a].append(b)
                neighbours[b].append(a)
    form = {}
    for w in words:
        if neighbours[w]:
            best = min(neighbours[w], key=lambda x: (-counts[x], x))
            if counts[best] >= ratio * counts[w]:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), counts[w], len(neighbours[w]), counts[form[w]] if w in form else None) for w in words}


def counted(rows, every=None, least=5, times=3):
    total = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if every and h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= least and n >= times}


@pytest.mark.parametrize("crowd", [4096, 4])
def test_spellings_against_brute_force(spark, crowd):
    rng = random.Random(crowd)
    words = {"".join(rng.choice("aabcé") for _ in range(rng.randrange(5, 9))): rng.randrange(3, 400) for _ in range(500)}
    words |= {"z" * n: n for n in (5, 6, 7, 300, 301, 2000)}
    table = spark.createDataFrame([(w, n, "x") for w, n in words.items()], "word string, n long, form string").repartition(3)
    got = {tuple(r) for r in spelling_groups(table, crowd=crowd).collect()}
    assert got == grouped(words)
    if crowd == 4:
        assert buckets(table, crowd=crowd).where(F.length("path") > 2).count() > 0


def test_spellings_of_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {tuple(r) for r in queries.op13_spelling_groups(spark, SMALL).collect()}
    assert got == grouped(counted(rows, 97))


def test_vocabulary_of_odd_rows(spark):
    text = "Ärger ÄRGER ärger Straße straße×x STRASSE strasse Strasse abcd abcd abcd ŁŁŁŁŁŁ"
    rows = [(1, text), (1, text), (None, text), (None, None), (2, ""), (3, "lang" * 100_000), (4, "Straße")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("x"))
    for every in (None, 2, 97):
        assert {r.word: r.n for r in vocabulary(docs, drop_letter_every=every).collect()} == counted(rows, every)
    assert vocabulary(docs.limit(0)).collect() == []
    assert spelling_groups(vocabulary(docs.limit(0))).collect() == []


# Conversations

LEGAL = re.compile(r"(s?(ua)+)?\Z")


def harm(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def repaired(rows):
    """``rows`` are (turn, role, text) in order: faults and the cheapest edits, keeping every best audit per role prefix."""
    seen, edits, count = set(), [], Counter()
    for turn, role, text in rows:
        body = text.strip(BLANK)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        count[fault] += 1
        edits.append((role, text, fault))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))

    def phase(made):  # how the grammar goes on depends on this only
        return (made[:1] == "s", len(made) % 2) if made else ""

    def fits(made):
        return re.fullmatch(r"(s?(ua)*u?)?", made) is not None

    def relaxed(front):
        best = {}
        for cost, audit, made, lines in front:
            for k in range(3):
                if fits(made):
                    key = (phase(made), made[-1:])
                    best[key] = min(best.get(key, (cost, audit, made, lines)), (cost, audit, made, lines))
                role = "a" if made[-1:] == "u" else "u"
                cost, audit, made, lines = cost + 3, audit + "I", made + role, lines + [{"u": "user", "a": "assistant"}[role] + ":"]
        return list(best.values())

    front = [(0, "", "", [])]
    for role, text, fault in edits:
        after = []
        for cost, audit, made, lines in relaxed(front):
            after.append((cost + 4, audit + "D", made, lines))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault else 0
                if fits(made + role[:1]) and role[:1]:
                    after.append((cost + extra, audit + "K", made + role[:1], lines + [f"{role}:{text}"]))
                for new in ("user", "assistant"):
                    if fits(made + new[0]):
                        after.append((cost + 3 + extra, audit + "R", made + new[0], lines + [f"{new}:{text}"]))
        front = after
    cost, audit, _, lines = min(x for x in relaxed(front) if LEGAL.match(x[2]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest)


def expected(rows, damage=True):
    convs = defaultdict(list)
    for conv, turn, role, text in harm(rows) if damage else rows:
        convs[conv].append((turn, " " if role is None else role, " " if text is None else text))
    for conv, *_ in rows:
        convs[conv]
    order = lambda r: (r[0] is not None, r[0] or 0)
    return {conv: repaired(sorted(found, key=order)) for conv, found in convs.items()}


def results(spark, rows):
    found, left = repair_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3))
    found = found.join(conversation_digests(left).withColumnRenamed("conv_id", "c"), F.expr("conv_id <=> c"), "left").drop("c")
    nothing = hashlib.sha256(b"").hexdigest()
    return {r.conv_id: (*tuple(r)[1:8], r.repaired_sha256 or nothing) for r in found.collect()}


def talk(rng, conv, n, parts=("Yes.", "No?", "Well", " ", "", "So it is!", "ok \n", "Éa.")):
    roles = ["system", "user", "assistant", "tool", ""]
    return [
        (conv, turn, rng.choice(roles[1:3] * 4 + roles), rng.choice(parts) + (str(rng.randrange(9)) + "." if rng.random() < 0.7 else ""))
        for turn in range(n)
    ]


def test_conversations_of_a_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in queries.op11_conversation_repair(spark, SMALL).collect()}
    assert got == expected(rows)


def test_conversations_against_brute_force(spark):
    rng = random.Random(5)
    rows = [row for conv in range(150) for row in talk(rng, conv, rng.randrange(1, 9))]
    rows += [(None, None, "user", "One."), (None, 3, "assistant", None), (200, None, None, "x"), (201, 1, "user", "Twice."), (201, 1, "user", "Twice.")]
    rows += [(202, 5, "user", "long " * 50_000), (202, 9, "assistant", "end.")]
    rng.shuffle(rows)
    assert results(spark, rows) == expected(rows, damage=False)


def test_long_conversations_span_parts(spark):
    """More rows than a partition takes: the parts are searched on their own and joined."""
    rng = random.Random(8)
    rows = talk(rng, 1, 900) + talk(rng, 2, 700) + [r for c in range(3, 20) for r in talk(rng, c, 6)]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert results(spark, rows) == expected(rows, damage=False)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_conversations_of_odd_tables(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    found, left = repair_conversations(empty)
    assert found.collect() == [] and conversation_digests(left).collect() == []
    extra = spark.createDataFrame([("a", 1, "user", "Hi.", "x")], "conv_id string, turn int, role string, text string, part string")
    (row,) = repair_conversations(extra)[0].collect()
    assert (row.conv_id, row.cost, row.audit) == ("a", 3, "KI")
    assert damaged_conversations(empty).collect() == []
