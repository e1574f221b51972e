"""Extraction, chat formatting, packing, pieces, classifier, pipeline."""

import hashlib
import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from roadloom.llm import chat_format, common, html_extract, packing, piece_codec, quality_fm, queries
from roadloom.llm.packing import BLOCK, WordEncoder

from . import brute
from .test_near_copies import brute_components
from .conftest import DOCS, ODD, key, rows_of

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="no-sidebar">
<nav><a href=x>menu</a></nav><div class="cookie-notice">We use cookies</div><!-- <p>gone</p> -->
<div class="wrap{n}"><div class="content post-{n}"><h1>Head &amp; more</h1><p>First  para,\n with <b>bo</b>ld&nbsp;text.<p>Second, para<br>line {n}.
<script>var t="</p>";</script><ul><li>one<li>two</ul><form><input>Send</form></div><div id="comments"><p>I disagree, and so on and on. Very much, indeed, so.</p></div></div>
<aside>aside</aside><footer>&copy; us</footer></body></html>"""


def test_extraction_of_a_full_page():
    want = "Head & more First para, with bold text. Second, para line 7. one two"
    nodes = html_extract.containers(PAGE.format(n=7))
    top = html_extract.best(nodes)
    assert top.path.endswith("div.content.post-0")
    assert html_extract.text_at(nodes, top.path) == want
    assert html_extract.text_at(nodes, "/nowhere") == want


def test_odd_pages():
    for page in ("", "   ", "just text &lt;b&gt; &am &amp", "<p>a<p>b", "<article><p>x</article></article></div>", "<div><div><div>deep", "<a <b>>", "<script>never closed", "<p>" * 5000 + "x", "1 < 2 and 3 > 2"):
        html_extract.text_at(html_extract.containers(page), None)
    assert html_extract.text_at(html_extract.containers("just text &lt;b&gt; &am &amp"), None) == "just text <b> &am &"
    assert html_extract.text_at(html_extract.containers("<p>a<p>b"), None) == "a b"


def test_text_dealt_over_siblings():
    sides = "<div class=sidebar><p>Side, and side.</p></div>"
    one = f"<body><article><h1>Title</h1><div class=lead><p>Lead, here.</p></div><div class=body><p>{'Body, text. ' * 9}</p></div></article>{sides}</body>"
    two = f"<body><div id=top><a href=x>Go, on</a></div><div id=page><h2>Title</h2><div><p>{'First, part. ' * 9}</p></div><div><p>{'Second, part. ' * 9}</p></div></div>{sides}</body>"
    for page, want in ((one, f"Title Lead, here. {'Body, text. ' * 9}"), (two, f"Title {'First, part. ' * 9}{'Second, part. ' * 9}")):
        nodes = html_extract.containers(page)
        assert html_extract.text_at(nodes, html_extract.best(nodes).path) == want.strip()
    open_quote = '<article><p title="it>One, two.<p>Three, four.</article>'
    assert html_extract.text_at(html_extract.containers(open_quote), None) == "One, two. Three, four."


def test_hosts_agree_on_a_path(spark):
    good = [(i, f"https://H.example.com:80/{i}", PAGE.format(n=i)) for i in range(5)]
    # on its own this page's comments outweigh its article
    odd = PAGE.format(n=9).replace("I disagree", "I disagree, with all of it. " * 30).replace('id="comments"', 'class="talk"')
    rows = [*good, (5, "https://h.example.com/9", odd), (6, None, None), (6, None, None), (7, "x", "<p>lone</p>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("path", F.lit("clash")).withColumn("host", F.lit("clash"))
    got = defaultdict(list)
    for r in html_extract.extract(df).collect():
        got[r.page_id].append(r.text)
    assert got[5] == ["Head & more First para, with bold text. Second, para line 9. one two"]
    assert got[6] == ["", ""] and got[7] == ["lone"]
    assert html_extract.extract(df.limit(0)).count() == 0


def test_pages_hold_the_article_alone(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.op2_html_extract(spark, sf_dir).collect():
        html = pages[r.page_id].html
        article = html[html.index("<article>") : html.index("</article>")]
        assert len(r.text) == r.n_chars
        import html as h
        import re

        assert r.text == " ".join(" ".join(h.unescape(x).split()) for x in re.split("</?(?:article|h1|p|br)>", article.replace("<b>", "")) if x.strip())


CONVERSATIONS = [
    (1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (1, 1, "assistant", "<!|im_end|><!!|<|"), (1, 2, "assistant", "\n\n\U0001f600é<"), (1, 3, "assistant", "|x|>"),
    (2, 1, "assistant", None), (2, 0, "system<|im_text|>", ""), (3, None, None, "null role"), (None, 0, "assistant", "null id <|endoftext|>"), (4, 0, "assistant", "a"), (4, 0, "assistant", "a"),
]


def test_chat_round_trip(spark):
    path = queries.tokenizer_path("byte_bpe_50k.json")
    df = spark.createDataFrame(CONVERSATIONS, "conv_id bigint, turn bigint, role string, text string").withColumn("ids", F.lit("clash"))
    got = {r.conv_id: r for r in chat_format.format_chats(df, path).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv, row in got.items():
        turns = [(r or "", t or "") for _, _, r, t in sorted((x for x in CONVERSATIONS if x[0] == conv), key=lambda x: (x[1] or 0, x[2] or "", x[3] or ""))]
        assert chat_format.parse(row.formatted) == turns
        assert "".join(chat_format.loss_texts(row.ids, row.mask, path)) == "".join(t for r, t in turns if r == "assistant")
        assert chat_format.load_tokenizer(path).decode(row.ids, skip_special_tokens=False) == row.formatted
    assert chat_format.format_chats(df.limit(0), path).count() == 0


def test_chat_query(spark, sf_dir):
    convs = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        convs[r.conv_id].append((r.role, r.text or ""))
    convs[-1] = [("user", queries.CONTROL), ("assistant", queries.CONTROL)]
    got = rows_of(queries.op6_chat_format(spark, sf_dir), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    want = []
    for c, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        want.append((c, len(turns), brute.sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), brute.sha(loss)))
    assert key(got) == key(want)


@pytest.fixture(scope="module")
def words():
    return WordEncoder(queries.tokenizer_path("word_bpe_49k.json"))


def plain_ids(words, text):
    return words.tokenizer.encode(text, add_special_tokens=False).ids


def test_remembered_words_give_the_tokenizers_ids(words, docs):
    rng = random.Random(3)
    alphabet = "aZé'sßÀ×÷µª²½́İ \xa0\x85\x1c \n\t.,!<|>_0٣你\U0001f600'"
    texts = [t or "" for (t,) in rows_of(docs, "text")] + [t or "" for t in ODD] + ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(3000)]
    texts += ["I'LL we're it's'd 's ''ll", "<|startoftext|>x<|endoftext|>", "<|STARTOFTEXT|>"]
    for text in texts:
        assert list(np.frombuffer(words.encode(text), "<u4")) == plain_ids(words, text), text[:100]


def test_texts_encoded_together_keep_their_own_ids(words, monkeypatch):
    """Plain and other texts in one call, in parts of any size, with every apostrophe case at edges."""
    rng = random.Random(5)
    texts = ["".join(rng.choices("aSt'l'veRdm' \n\r\t!9é×", k=rng.randrange(30))) for _ in range(2000)] + ["", " ", "\n", "'", "漢 'S", "<|endoftext|>'s", "x" * 500, "'re", "s"]
    rng.shuffle(texts)
    want = [plain_ids(words, t) for t in texts]
    for part in (1, 7, 1000, 1 << 21):
        monkeypatch.setattr(packing, "PART", part)
        assert [np.frombuffer(x, "<u4").tolist() for x in words.encode_all(texts)] == want
    assert words.encode_all([]) == []


def test_new_words_of_many_texts_share_calls(monkeypatch):
    """New words of a batch go to the tokenizer 256 to a call, not text by text; none is asked for twice."""
    one = WordEncoder(queries.tokenizer_path("word_bpe_49k.json"))
    asked, plain = [], one.tokenizer

    class Counted:
        def encode(self, text, **options):
            asked.append(text)
            return plain.encode(text, **options)

    monkeypatch.setattr(one, "tokenizer", Counted())
    texts = [f"the {a}{b}q and {b}{a}z, Don't" for a in "abcdefghijklmnop" for b in "abcdefghijklmnop"]
    for _ in range(2):
        got = one.encode_all(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(asked) <= 3 and len(words := " ".join(asked).split()) == len(set(words))


def test_memo_begins_anew_without_losing_ids(monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 8)
    one = WordEncoder(queries.tokenizer_path("word_bpe_49k.json"))
    for texts in (["a b c d e f", "g h i j 漢字 ü漢"], ["a z y x w v u t s r q p o n", "c d"], ["漢字 漢字 b ü漢 " * 9, "b"]):
        assert [np.frombuffer(x, "<u4").tolist() for x in one.encode_all(texts)] == [plain_ids(one, t) for t in texts]


@pytest.mark.parametrize("which", ["docs", "odd", "none"])
def test_pieces_tile_documents_and_sequences(which, request, words):
    df = request.getfixturevalue(which)
    got = packing.pack(df, queries.tokenizer_path("word_bpe_49k.json")).collect()
    want = defaultdict(list)
    for i, t in rows_of(df, "doc_id", "text"):
        want[i].append([*plain_ids(words, t or ""), 1])
    streams, docs = defaultdict(list), defaultdict(list)
    for r in got:
        ids = struct.unpack(f"<{r.length}I", r.ids)
        streams[r.sequence_id].append((r.offset, ids))
        docs[r.doc_id].append((r.start, r.length, r.doc_tokens, ids))
    for n, seq in streams.items():
        at = 0
        for offset, ids in sorted(seq):
            assert offset == at
            at += len(ids)
        assert at == 2048 or n == max(streams)
    assert sorted(streams) == list(range(len(streams)))
    total = defaultdict(int)
    for i, pieces in docs.items():
        if len(want[i]) == 1:
            assert [x for p in sorted(pieces) for x in p[3]] == want[i][0]
        total[i] = sum(p[1] for p in pieces)
    assert total == {i: sum(map(len, w)) for i, w in want.items()}


def test_blocks_of_a_long_document(spark, words):
    text = "ab cd " * BLOCK
    df = spark.createDataFrame([(1, text, None, None, None), (2, "x", None, None, None)], DOCS)
    got = sorted((r.doc_id, r.start, r.ids) for r in packing.pack(df, queries.tokenizer_path("word_bpe_49k.json")).collect())
    assert b"".join(x[2] for x in got if x[0] == 1) == words.encode(text) + b"\1\0\0\0"


def test_packing_query_has_the_checksums(spark, sf_dir, words):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op7_packing(spark, sf_dir).collect():
        ids = [*plain_ids(words, texts[r.doc_id]), 1]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[r.start : r.start + r.length]))


def test_pieces_and_spans(spark, docs, odd):
    import sentencepiece

    path = queries.tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for df in (docs, odd, docs.limit(0)):
        texts = key(rows_of(df, "doc_id", "text"))
        got = key(rows_of(piece_codec.encode_pieces(df, path), "doc_id", "ids", "starts", "ends"))
        assert key([(i, model.encode(t or "", add_eos=True)) for i, t in texts]) == key([(i, ids) for i, ids, _, _ in got])
        back = piece_codec.decode_pieces(piece_codec.encode_pieces(df, path), path)
        assert key(rows_of(back, "doc_id", "text")) == key([(i, model.decode(model.encode(t or ""))) for i, t in texts])
    for text in (t or "" for t in ODD):
        codec = piece_codec.codec(path)
        ids = codec.encode(text)
        starts, ends = codec.spans(text, ids)
        data = text.encode()
        assert b"".join(data[s:e] for s, e in zip(starts, ends, strict=True)) == data
        for i, s, e in zip(ids, starts, ends, strict=True):
            if not (model.is_control(int(i)) or model.is_byte(int(i))):
                assert data[s:e].decode().replace(" ", "▁") == model.id_to_piece(int(i)).removeprefix("▁" if s == 0 else "") or s == 0


def compiled(keys):
    """A double array of the public format for a few keys: one unit a state, placed one by one."""
    pool, units, taken = b"", {0: 0}, {0}
    values = {}
    for k, v in keys.items():
        values[k] = len(pool)
        pool += v + b"\0"
    trie = {b""} | {k[:i] for k in keys for i in range(1, len(k) + 1)}

    def place(state, at):
        labels = sorted({t[len(state)] for t in trie if len(t) == len(state) + 1 and t[: len(state)] == state})
        all_labels = ([0] if state in values else []) + labels
        base = next(b for b in range(1, 1 << 16) if not any((b ^ x) in taken for x in all_labels) and (at ^ b) < 1 << 21)
        taken.update(base ^ x for x in all_labels)
        units[at] |= (at ^ base) << 10 | (1 << 8 if state in values else 0)
        if state in values:
            units[base] = 1 << 31 | values[state]
        for x in labels:
            units[base ^ x] = x
        for x in labels:
            place(state + bytes([x]), base ^ x)

    place(b"", 0)
    array = np.zeros(max(units) + 256, "<u4")
    for at, u in units.items():
        array[at] = u
    return struct.pack("<I", array.nbytes) + array.tobytes() + pool


def test_character_map_takes_the_longest_prefix():
    keys = {b"a": b"1", b"ab": b"22", b"abc": b"", "é".encode(): b"e", b"\t": b" "}
    table = piece_codec.CharacterMap.parse(compiled(keys))
    assert table.longest(b"abd", 0) == (2, b"22") and table.longest(b"abcd", 0) == (3, b"") and table.longest(b"xa", 1) == (1, b"1")
    assert table.longest(b"b", 0) is None and table.longest("é".encode(), 0) == (2, b"e")
    codec = piece_codec.PieceCodec(queries.tokenizer_path("piece_bpe_32k.model"))
    codec.map, codec.trim = table, True
    normal, source = codec.normalise(" xé\t  ab ".encode())
    assert normal == "▁xe▁22".encode()
    assert source.tolist() == [1, 1, 1, 1, 2, 4, 4, 4, 7, 7, 9]


def test_machine_scores_by_the_identity():
    rng = np.random.default_rng(1)
    m = quality_fm.FactorisationMachine(np.zeros(6), np.ones(6), 0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    x = rng.normal(size=(4, 6))
    pairs = [0.3 + r @ m.weights + sum(m.factors[i] @ m.factors[j] * r[i] * r[j] for i in range(6) for j in range(i)) for r in x]
    assert np.allclose(m.raw(x), pairs)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.op9_quality_fm(spark, sf).join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").toPandas()
    assert got.score.between(0, 1).all()
    assert (got.predicted == got.quality).mean() > 0.9
    good, bad = got[got.quality == 1].score.to_numpy(), got[got.quality == 0].score.to_numpy()
    auc = (good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean()
    print("held-out accuracy", (got.predicted == got.quality).mean(), "auc", auc)
    assert auc > 0.85


def test_scores_of_odd_texts(spark, docs, odd, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_fm.train(docs, labels)
    assert quality_fm.score(odd, model).where("score between 0 and 1").count() == odd.count()
    assert quality_fm.score(odd.limit(0), model).count() == 0
    constant = quality_fm.train(docs, labels.limit(0))
    assert quality_fm.score(docs, constant).where("score = 0.5").count() == docs.count()
    got = rows_of(docs.select("doc_id", quality_fm.remainder().alias("m")), "doc_id", "m")
    assert all(zlib.crc32(str(i).encode()) % 5 == m for i, m in got)


def test_pipeline(spark, sf_dir, words):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at, frames = docs, []
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, sf_dir)
        frames.append(at)
    assert all(f.columns == docs.columns for f in frames[:-1])
    rules, exact, near, masked, packed = [f.collect() for f in frames]
    best = {}
    for r in rules:
        best[r.text] = max(best.get(r.text, -1), r.doc_id)
    assert sorted(r.doc_id for r in exact) == sorted(best.values())
    # near copies are those of five-word Jaccard 0.8 or more, by comparing all pairs
    parts, _ = brute_components([(r.doc_id, r.text) for r in exact])
    assert sorted(r.doc_id for r in near) == sorted(set(parts.values()))
    assert sorted(r.doc_id for r in masked) == sorted(r.doc_id for r in near)
    tokens = {r.doc_id: len(plain_ids(words, r.text)) + 1 for r in masked}
    total = defaultdict(int)
    for r in packed:
        total[r.doc_id] += r.length
    assert dict(total) == tokens
    whole = {tuple(r) for r in corpus_pipeline.run(spark, sf_dir).select("doc_id", "doc_tokens").distinct().collect()}
    assert whole == {(i, n) for i, n in tokens.items()}


@pytest.mark.parametrize("which", ["odd", "none"])
def test_pipeline_on_odd_rows(spark, sf_dir, which, request):
    at = request.getfixturevalue(which)
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, sf_dir)
    at.collect()


def test_digest_helper():
    assert brute.sha("") == hashlib.sha256(b"").hexdigest()


def test_rows_without_a_conversation_stand_alone(spark):
    tokenizer = queries.tokenizer_path("byte_bpe_50k.json")
    rows = [(None, 0, "user", "same")] * 5 + [(None, 1, "assistant", "other")] + [("b", 0, "user", "hi"), ("b", 1, "assistant", "ho"), ("", 0, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string").withColumn("formatted", F.lit("clash"))
    got = [(r.conv_id, chat_format.parse(r.formatted)) for r in chat_format.format_chats(df, tokenizer).collect()]
    want = [(None, [("user", "same")])] * 5 + [(None, [("assistant", "other")]), ("b", [("user", "hi"), ("assistant", "ho")]), ("", [("assistant", "")])]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("kind", ["string", "int", "bigint", "decimal(10,0)", "date", "binary"])
def test_conversations_with_ids_of_any_type(spark, kind):
    value = "2024-01-02" if kind == "date" else "7"
    df = spark.createDataFrame([(0, "user", "hi"), (1, "assistant", "ho")], "turn int, role string, text string").withColumn("conv_id", F.lit(value).cast(kind))
    got = chat_format.format_chats(df, queries.tokenizer_path("byte_bpe_50k.json"))
    assert got.schema["conv_id"].dataType.simpleString() == kind and got.first().n_turns == 2
    assert chat_format.format_chats(df.limit(0), queries.tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_fit_is_the_same_under_repeated_ids(spark, docs):
    rows = docs.limit(60).select("doc_id", "text")
    twice = rows.unionByName(rows.select("doc_id", F.reverse("text").alias("text")))
    labels = rows.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    a, b = (quality_fm.train(df, labels) for df in (twice.repartition(7), twice.repartition(3, "text")))
    assert (a.weights == b.weights).all() and (a.factors == b.factors).all()


def test_batches_leave_the_session_as_it_is(spark, docs):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    seen = [b.num_rows for b in common.small_batches(iter([pa.record_batch({"x": list(range(1000))})]))]
    quality_fm.feature_rows(docs).count()
    assert seen == [256, 256, 256, 232] and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_other_tokenizer_files_encode_whole_texts(tmp_path):
    """A file with other parts than those that the cuts assume isn't taken for one of them."""
    import json

    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    parts = json.loads(open(path, encoding="utf-8").read())
    parts["normalizer"]["normalizers"] = parts["normalizer"]["normalizers"][:2]  # capitals stay
    (tmp_path / "cased.json").write_text(json.dumps(parts), encoding="utf-8")
    for file, by_words in ((path, True), (str(tmp_path / "cased.json"), False), (queries.tokenizer_path("byte_bpe_50k.json"), False)):
        one, plain = WordEncoder(file), Tokenizer.from_file(file)
        assert one.by_words is by_words
        for text in ("", "Plain Words, don't  cut\nthem", "Ünï 漢字 12 3", "a" * 3000):
            assert np.frombuffer(one.encode(text), dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
