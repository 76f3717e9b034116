"""Chat formatting, the Merkle manifest and periodic runs, held against plain Python."""

import hashlib
import random
import zlib

import pytest
from conftest_llm import ODD
from pyspark.sql import functions as F

from skyops.llm import chat_format, merkle, periodic_runs, queries

# --- periodic runs ---


def all_runs(w):
    """Every lag compared word by word; a stretch counts with its least period."""
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] == w[i + q]:
                j = i
                while j + q < len(w) and w[j] == w[j + q]:
                    j += 1
                if j + q - i >= max(6, 4 * q):
                    out.setdefault((i, j + q), q)
                i = j
            i += 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def periodic(rng, words):
    """Stretches of chance words and of repeats with any share of a last period, few or many words."""
    out = []
    for _ in range(rng.randrange(6)):
        pick = lambda n: [rng.randrange(words) for _ in range(n)]
        if rng.random() < 0.4:
            out += pick(rng.randrange(60))
        else:
            base = pick(rng.randrange(1, rng.choice([4, 12, 40, 90])))
            out += (base * 8)[: rng.randrange(1, 7 * len(base) + 2)]
    return out


@pytest.mark.parametrize("words", [1, 2, 3, 60])
def test_runs_equal_all_lags(words):
    rng = random.Random(words)
    for _ in range(250):
        texts = [periodic(rng, words) for _ in range(rng.randrange(1, 6))]
        assert [[tuple(r) for r in found.tolist()] for found in periodic_runs.runs(texts)] == [all_runs(t) for t in texts]


def test_stretches_that_words_deny_are_scanned_again(monkeypatch):
    real = periodic_runs.Spans.extended
    monkeypatch.setattr(periodic_runs.Spans, "extended", lambda s, at, lag: tuple(x + d for x, d in zip(real(s, at, lag), (-1, 1))))
    text = [*range(100, 130), *(list(range(20)) * 5), *range(200, 230)]
    assert periodic_runs.runs([text])[0].tolist() == [[30, 100, 20]]


def shortened(w, found):
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in drop)


def numbered(words):
    of = {}
    return [of.setdefault(w, len(of)) for w in words]


def test_runs_of_odd_texts(docs_of):
    rng = random.Random(5)
    long = " ".join(["a b c d e f g h i j"] * 30_000)
    rows = [*ODD, *((100 + k, " ".join(map(str, periodic(rng, 4)))) for k in range(40)), (900, long), (901, "x y " * 6),
            (902, "é\té\né é\x0bé\x0cé\ré"), (903, "one " * 5), (904, "one " * 6)]
    docs = docs_of(rows).withColumnRenamed("ids", "runs")
    got = sorted(((r.doc_id, r.text, [tuple(x) for x in r.runs], r.collapsed, r.score) for r in periodic_runs.find(docs).collect()), key=repr)
    want = []
    for i, t in rows:
        w = (t or "").encode().split()
        found = [(0, 300_000, 10)] if t is long else all_runs(numbered(w))
        want.append((i, t, found, shortened(w, found).decode(), "y"))
    assert got == sorted(want, key=repr)
    assert periodic_runs.find(docs.limit(0)).count() == 0


def test_runs_query(spark, small):
    want = []
    for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect():
        w = (r.text or "").encode().split()
        n, h = len(w), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = all_runs(numbered(w))
        top = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in found)
        want.append((r.doc_id, len(found), *((*top, 1000 * top[1] // top[2]) if top else (None,) * 4), sha(lines),
                     hashlib.sha256(shortened(w, found)).hexdigest()))
    got = queries.QUERIES["op13_periodic_runs"](spark, small).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr) and any(r.n_runs for r in got)


# --- Merkle manifest ---


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row_digest(r):
    values = ["-" if r[c] is None else f"{len(str(r[c]).encode())}:{r[c]}" for c in queries.LEAF]
    return sha("".join(values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 3])) for k in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, i):
    out = []
    for nodes in tree[:-1]:
        first = i // 3 * 3
        out.append(("".join(nodes[first:i]), "".join(nodes[i + 1 : first + 3])))
        i //= 3
    return out


def plain_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = []
    for k in keys:
        groups[k].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, row_digest(r)))
        trees.append(levels([row_digest(r) for r in groups[k]]))
    top = levels([t[-1][0] for t in trees])
    out = []
    for t, k in enumerate(keys):
        for i, r in enumerate(groups[k]):
            path = siblings(trees[t], i) + siblings(top, t)
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None
            at = row_digest(r | {"text": r["text"].replace("\n", "")} if tampered else r)
            for before, after in path:
                at = sha(before + at + after)
            out.append((r["doc_id"], trees[t][0][i], trees[t][-1][0], top[-1][0], sha("".join(b + a for b, a in path)), at,
                        at == top[-1][0]))
    return sorted(out, key=repr), trees


def odd_documents(docs_of):
    rows = [*ODD, *ODD, *((k, f"line {k}\nline" if k % 3 else None) for k in range(70)), (7, "other text"), (None, "other"), (None, None)]
    docs = docs_of(rows)
    source = F.when(F.col("doc_id") == 8, None).when(F.col("doc_id") == 9, "").when(F.col("doc_id") < 40, "src").otherwise(F.col("source"))
    return docs.withColumns({"source": source, "lang": F.when(F.col("doc_id") % 5 > 0, F.col("lang"))})


def manifest_rows(spark, monkeypatch, docs):
    monkeypatch.setattr(queries, "table", lambda *a: docs)
    return sorted(map(tuple, queries.QUERIES["op12_merkle_manifest"](spark, "").collect()), key=repr)


@pytest.mark.parametrize("band", [1, 2, 5])
def test_manifest_of_odd_rows(spark, docs_of, monkeypatch, band):
    """Small bands make trees of many bands, so that ancestors come from several joins."""
    monkeypatch.setattr(merkle, "BAND", band)
    monkeypatch.setattr(merkle, "BLOCK", 3**band)
    docs = odd_documents(docs_of)
    assert manifest_rows(spark, monkeypatch, docs) == plain_manifest([r.asDict() for r in docs.collect()])[0]


def test_manifest_of_few_and_no_rows(spark, docs_of, monkeypatch):
    assert manifest_rows(spark, monkeypatch, docs_of([(1, "a")]).limit(0)) == []
    alone = manifest_rows(spark, monkeypatch, docs_of([(1, "a\nb")]))
    assert len(alone) == 1 and alone[0][1] == alone[0][2] == alone[0][3] and alone[0][4] == sha("")


@pytest.mark.parametrize("band", [1, 5])
def test_intervals_nest(docs_of, monkeypatch, band):
    monkeypatch.setattr(merkle, "BAND", band)
    monkeypatch.setattr(merkle, "BLOCK", 3**band)
    docs = odd_documents(docs_of)
    lower, _ = merkle.manifest(docs, "source", "doc_id", queries.LEAF)
    got = sorted(map(tuple, lower.nodes.collect()), key=repr)
    _, trees = plain_manifest([r.asDict() for r in docs.collect()])
    names = sorted({r.source for r in docs.collect()}, key=lambda k: (k is not None, (k or "").encode()))
    want = [(name, k, i * 3**k, min((i + 1) * 3**k, len(tree[0])), d)
            for name, tree in zip(names, trees) for k, nodes in enumerate(tree) for i, d in enumerate(nodes)]
    assert got == sorted(want, key=repr)


# --- chat formatting ---

CONTROLS = ["<|im_start|>", "<|im_end|>", "<|part|>", "<|image|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<unk>"]


def chance_text(rng):
    bits = [*CONTROLS, "<", "[", "\\", "|", "\n", "|>", "/INST]", "s>", "<\\s>", "<\\\\|image|>", "a", "é", "", " "]
    return "".join(rng.choice(bits) for _ in range(rng.randrange(12)))


def test_controls_are_escaped_and_given_back(spark):
    rng = random.Random(2)
    texts = [*CONTROLS, *(chance_text(rng) for _ in range(3000))]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat_format.escaped(F.col("t")).alias("e")).collect()
    for t, e in rows:
        assert chat_format.plain(e) == t and not any(c in e for c in CONTROLS if not c.startswith("<<"))
    assert len({e for _, e in rows}) == len(set(texts))


def chance_parts(rng):
    out = []
    for k in range(rng.randrange(5)):
        kind = rng.choice(["text", "text", "image", "audio", "document"])
        out.append({"type": kind, "text": chance_text(rng) if kind == "text" else None, "ref": None if kind == "text" else f"file:{k}",
                    "width": 57, "height": 28, "seconds": 1.5, "pages": 2})
    return out


TOKENS = {"image": 4, "audio": 38, "document": 2048}


@pytest.mark.parametrize("chunk", [1, 200, 1 << 16])
def test_parts_are_given_back_in_order(spark, chunk):
    rng = random.Random(chunk)
    rows = [(c, t, rng.choice(["user", "assistant", "a\\n\n<|im_end|>"]), chance_parts(rng)) for c in range(12) for t in range(rng.randrange(1, 7))]
    df = spark.createDataFrame(rows, f"conv_id long, turn int, role string, parts array<{chat_format.PART}>").repartition(3)
    found = {}
    for r in sorted(chat_format.format(df, F.col("parts"), chunk=chunk).collect(), key=lambda r: (r.conv_id, r.part, r.chunk)):
        turns, refs, loss = found.setdefault(r.conv_id, ([], [], []))
        here = list(chat_format.read(r.formatted))
        assert r.n_turns == len(here) and sum(p is None for _, parts in here for p in parts) == len(r.attachments)
        assert all(r.formatted.startswith(chat_format.PLACEHOLDERS[a.kind], a.at) for a in r.attachments)
        turns += here
        refs += [(a.kind, a.ref, a.tokens) for a in r.attachments]
        loss += [chat_format.plain(r.formatted[s.start : s.end]) for s in r.spans]
    for c in range(12):
        mine = [r for r in rows if r[0] == c]
        want = [(role, [p["text"] if p["type"] == "text" else None for p in parts] or [""]) for _, _, role, parts in mine]
        assert found[c][0] == want
        assert found[c][1] == [(p["type"], p["ref"], TOKENS[p["type"]]) for *_, parts in mine for p in parts if p["type"] != "text"]
        assert found[c][2] == [p["text"] for _, _, role, parts in mine if role == "assistant" for p in parts if p["type"] == "text"]


def test_odd_conversations(spark, monkeypatch):
    long = "[INST] words " * 20_000
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, None, None, "first"), (None, 0, "assistant", "a</s>"), (None, 1, "user", "b"),
            (2, 0, "assistant", long), (2, 1, "assistant", long), (3, 0, "user", "x"), (3, 0, "user", "x"), (3, 0, "assistant", "y")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    monkeypatch.setattr(queries, "table", lambda *a: df)
    got = {r.conv_id: r for r in queries.QUERIES["op11_chat_format"](spark, "").collect()}
    assert set(got) == {None, -1, 1, 2, 3}
    turns = {1: [("", "first"), ("user", ""), ("assistant", "")], None: [("assistant", "a</s>"), ("user", "b")],
             2: [("assistant", long)] * 2, 3: [("assistant", "y"), ("user", "x"), ("user", "x")],
             -1: [(r, "</s>[INST] ok [/INST]") for r in ("user", "assistant")]}
    for conv, want in turns.items():
        loss = "".join(t for r, t in want if r == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(want), sha("".join(f"{r}\n{t}\n" for r, t in want)))
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), sha(loss))
    assert got[-1].formatted_chars == 2 * (len("<|im_start|>\n<|im_end|>\n") + len("</s>[INST] ok [/INST]") + 3) + len("userassistant")
    monkeypatch.setattr(queries, "table", lambda *a: df.limit(0))
    assert [r.conv_id for r in queries.QUERIES["op11_chat_format"](spark, "").collect()] == [-1]


def test_odd_parts(spark):
    rows = [(1, 0, "user", [None, {"type": "video", "ref": "v"}, {"type": None, "text": "t"}, {"type": "IMAGE", "ref": None}]), (2, 0, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, parts array<struct<type:string,text:string,ref:string>>")
    got = {r.conv_id: r for r in chat_format.format(df, F.col("parts")).collect()}
    assert got[1].formatted == "<|im_start|>user\n<|part|><|document|>t<|image|><|im_end|>\n"
    assert [(a.kind, a.ref, a.tokens) for a in got[1].attachments] == [("document", "v", 1024), ("image", None, 2)]
    assert got[2].formatted == "<|im_start|>user\n<|im_end|>\n"
