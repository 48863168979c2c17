"""Language model, decontamination, classifier and tokenizers against plain versions and the libraries."""

from __future__ import annotations

import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import plain  # noqa: E402

from firmweave.llm import decontaminate, kneser_ney, quality, sentencepiece_codec, token_counts, words  # noqa: E402
from firmweave.llm.memo import Memo  # noqa: E402
from firmweave.llm.queries import QUERIES, tokenizer_file  # noqa: E402
from firmweave.llm.tables import pack_sorted, unpack_sorted  # noqa: E402


@pytest.fixture(scope="module")
def docs(spark):
    rows = plain.odd_documents(2)
    return rows, plain.frame(spark, rows)


# --- language model


def plain_scores(rows, held, order):
    begin, end = "\0begin", "\0end"
    split = [plain.words((t or "").translate(plain.LOWER)) + [end] for _, t in rows]
    padded = [[begin] * (order - 1) + w for w in split]
    counts = {order: Counter(tuple(s[p - order + 1 : p + 1]) for s, h in zip(padded, held, strict=True) if not h for p in range(order - 1, len(s)))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    unigrams = Counter(w for s, h in zip(split, held, strict=True) if not h for w in s)
    tokens, vocabulary = sum(unigrams.values()), len(unigrams)
    less = {k: [0, *kneser_ney.discounts([sum(v == m for v in c.values()) for m in (1, 2, 3, 4)])] for k, c in counts.items()}
    total, kinds = defaultdict(int), defaultdict(lambda: [0, 0, 0, 0])
    for k, c in counts.items():
        for g, v in c.items():
            total[k, g[:-1]] += v
            kinds[k, g[:-1]][min(v, 3)] += 1
    out = []
    for s, w in zip(padded, split, strict=True):
        score = 0.0
        for p in range(order - 1, len(s)):
            prob = 1 / (vocabulary + 1)
            for k in range(1, order + 1):
                g = tuple(s[p - k + 1 : p + 1])
                if total[k, g[:-1]]:
                    v = counts[k][g]
                    spare = sum(d * n for d, n in zip(less[k], kinds[k, g[:-1]], strict=True))
                    prob = (max(v - less[k][min(v, 3)], 0) + spare * prob) / total[k, g[:-1]]
            score += math.log10(prob)
        base = sum(math.log10((unigrams[x] + 1) / (tokens + vocabulary + 1)) for x in w)
        out.append((len(w), sum(unigrams[x] > 0 for x in w), tokens, base, score))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_kneser_ney(spark, docs, order):
    rows, df = docs
    held = [i is not None and i % 3 == 1 for i, _ in rows]
    got = kneser_ney.score_texts(df, F.pmod("doc_id", F.lit(3)) == 1, order)
    key = lambda r: tuple((x is not None, x) if not isinstance(x, float) else round(x, 6) for x in r)
    want = sorted(((i, h, *s) for (i, _), h, s in zip(rows, held, plain_scores(rows, held, order), strict=True)), key=key)
    have = sorted((tuple(r) for r in got.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), key=key)
    assert [r[:5] for r in have] == [r[:5] for r in want]
    assert [r[5:] for r in have] == [pytest.approx(r[5:]) for r in want]
    assert "_chunk" in got.columns and got.columns.count("kept") == 1


def test_language_model_query_uses_trigrams(spark):
    """The registered query scores by a context of two words."""
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    got = sorted((r.doc_id, r.held_out, r.score) for r in QUERIES["op5_language_model"](spark, folder).collect())
    scores = {order: sorted((i, h, s[-1]) for (i, _), h, s in zip(rows, held, plain_scores(rows, held, order), strict=True)) for order in (2, 3)}
    assert [r[:2] for r in got] == [r[:2] for r in scores[3]]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in scores[3]])
    assert [r[2] for r in got] != pytest.approx([r[2] for r in scores[2]])


def test_probabilities_sum_to_one():
    less = kneser_ney.discounts([10, 5, 3, 2])
    assert all(0 < d < c for d, c in zip(less, (1, 2, 3), strict=True))
    assert kneser_ney.discounts([0, 0, 0, 0]) == [0.5, 0.75, 1.0]


def test_language_model_without_rows_or_training(spark):
    assert kneser_ney.score_texts(spark.createDataFrame([], "doc_id long, text string"), F.lit(False)).count() == 0
    row = kneser_ney.score_texts(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), F.lit(True)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)


def test_packing():
    import numpy as np

    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000):
        for top in (3, 1 << 20, (1 << 64) - 1):
            v = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
            assert np.array_equal(unpack_sorted(pack_sorted(v)), v)


# --- decontamination


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(plain.LOWER))


def plain_contamination(rows, items, size=10):
    windows = defaultdict(set)
    for name, text in items:
        w = item_words(text)
        if name is not None and w:
            for p in range(max(1, len(w) - size + 1)):
                windows[tuple(w[p : p + size])].add(str(name))
    out = []
    for i, text in rows:
        w = item_words(text)
        hit, found = set(), set()
        for k in {len(x) for x in windows}:
            for p in range(len(w) - k + 1):
                if names := windows.get(tuple(w[p : p + k])):
                    hit.update(range(p, p + k))
                    found |= names
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return Counter(out)


@pytest.mark.parametrize("shard_bytes", [1 << 20, 200])
def test_decontamination(spark, monkeypatch, shard_bytes):
    """One automaton or several passes."""
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard_bytes)
    rng = random.Random(8)
    items = [(k, " ".join(rng.choice("abc") + rng.choice(["", "é", "1"]) for _ in range(rng.randint(1, 25)))) for k in range(12)]
    items += [(20, "a"), (21, "A!"), (22, None), (23, "?!"), (None, "zz zz"), (24, items[0][1]), (0, items[1][1])]
    rows = [(i, " ".join(rng.choice([rng.choice("abcAB"), "a-b", "c\nc", "é", "", "b1"]) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    rows += [(100, items[0][1].upper().replace(" ", "--")), (101, None), (102, ""), (103, "x" + items[2][1]), (None, items[3][1]), (100, items[4][1]), (104, items[5][1] + " " + items[5][1])]
    df = plain.frame(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(df, bench)
    have = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got.select("doc_id", "n_words", "n_hit", "items").collect())
    assert have == plain_contamination(rows, items)
    assert got.columns.count("n_words") == 1 and "_chunk" in got.columns
    # Offsets lead to the hit words in the bytes of the original text.
    n_spans = 0
    for r in got.select("text", "spans", "n_hit").collect():
        data, words = (r.text or "").encode(), re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.text or "").translate(plain.LOWER))
        n_spans += len(r.spans)
        assert sum(s["end"] - s["start"] for s in r.spans) == r.n_hit
        for s in r.spans:
            original = data[s["from_byte"] : s["to_byte"]].decode()
            assert item_words(original) == words[s["start"] : s["end"]]
            assert original[:1] not in "- \n" and original[-1:] not in "- \n"
    assert n_spans > 20
    kept = decontaminate.clean_documents(df, bench)
    assert kept.columns == df.columns and kept.count() == sum(n for r, n in have.items() if not r[2])


def test_decontamination_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert [tuple(r) for r in decontaminate.find_contamination(docs, none).select("n_words", "n_hit", "items").collect()] == [(3, 0, [])]
    assert decontaminate.find_contamination(docs.limit(0), none).count() == 0


# --- classifier


def test_classifier_on_held_out_labels(spark):
    """Fitted without a third of the labels: most of them are told right, and clean documents stay."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    unseen = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0
    judged = quality.judge(docs, labels.where(~unseen)).select("doc_id", "rejected")
    rows = labels.where(unseen).join(judged, "doc_id").select("quality", "toxic", "rejected").collect()
    kinds = Counter((r.quality == 0, r.toxic == 1, r.rejected) for r in rows)
    share = {k: kinds[(*k, True)] / max(1, kinds[(*k, True)] + kinds[(*k, False)]) for k in ((False, False), (False, True), (True, False))}
    assert share[False, True] > 0.95 and share[False, False] < 0.03 and share[True, False] > 0.8, share


def test_classifier_on_odd_rows(spark, docs):
    _, df = docs
    df = df.withColumn("source", F.when(F.col("doc_id") % 2 == 0, "s")).withColumn("lang", F.lit(None).cast("string")).withColumn("p_low", F.lit("x"))
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 1), (None, 0, 1), (4, None, None), (6, 1, None), (999, 0, 0)], "doc_id long, quality int, toxic int")
    judged = quality.judge(df, labels)
    assert judged.count() == df.count() and judged.where("p_low IS NULL OR p_toxic IS NULL").count() == 0
    assert quality.accepted(df, labels).columns == df.columns
    assert quality.judge(df, labels.limit(0)).where("rejected").count() == 0
    assert quality.judge(df.limit(0), labels).count() == 0


def test_sparse_sites_shrink_toward_the_prior(spark):
    rows = [("big", "p", 1, 0)] * 80 + [("big", "p", 0, 0)] * 20 + [("good", "p", 0, 0)] * 95 + [("good", "p", 1, 0)] * 5 + [("tiny", "p", 1, 0)]
    rows = spark.createDataFrame(rows, "site string, path string, low int, toxic int")
    got = {(r.site, r.path): r.rate_low for r in quality.site_posteriors(rows).collect()}
    base = got[None, None]
    assert base < got["tiny", "p"] < got["big", "p"] < 0.81 and got["good", "p"] < base and got["tiny", None] > base


# --- tokenizers

ODD = ["", " ", "  ", "a", " a", "a  b", "\n x", "x  y ", "don't  won't\t\tx <|endoftext|> y<|endoftext|>", "▁a ▁", "日本 語 ", "\U0001f600 \U0001f600\x00 \x1c x", "a" * 3000, "é" * 100 + " " * 50 + "x", "<s>a</s> <0x41>", "x  y  z \x85 q", "12 345 6's", "́a ​"]


@pytest.fixture(scope="module")
def texts():
    return [t or "" for _, t in plain.odd_documents(3)] + ODD


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter.load(tokenizer_file("byte_bpe_50k.json"))


def library_counts(counter, texts):
    return [len(e) for e in counter.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_token_counts_equal_the_library(counter, texts):
    assert counter.stable and counter.counts(texts) == library_counts(counter, texts) == counter.counts(texts)


@pytest.mark.parametrize("chunk, overlap", [(30, 4), (300, 20), (2000, 64)])
def test_spliced_chunks_equal_the_whole(counter, texts, chunk, overlap):
    small = token_counts.Counter(counter.tokenizer, True, huge=1, chunk=chunk, overlap=overlap)
    texts = [t[:4000] for t in texts]
    assert small.counts(texts) == library_counts(counter, texts)


def test_boundaries_without_spaces_are_stable(counter):
    """Cut anywhere that is told to be stable, both sides give the tokens of the whole."""
    rnd = random.Random(4)
    signs = ["a", "Z", "é", "日", "本", "、", "。", "1", "٣", "²", "'", "'s", "'ll", "-", "__", "<", "|", "<|endoftext|>", "\n", "\n\n", " ", "\t", "\x85", "\u200b", "\u3000", "\U0001f600", "\u0301", "Ⅷ", "\u1c80", "\U0001fae0", "\x1c", "ﬁ", "़"]
    for _ in range(400):
        text = "".join(rnd.choices(signs, k=rnd.randint(3, 25)))
        whole = library_counts(counter, [text])[0]
        for at in range(1, len(text) - 1):
            if counter.is_stable(text, at):
                assert sum(library_counts(counter, [text[:at], text[at:]])) == whole, (text, at)


@pytest.mark.parametrize("unit", ["日本語の文章、これは長い。", "x=f(1);y+=g[22];", "{\"k\":[1,2]},\n", "日本語"])
def test_texts_without_spaces_are_not_encoded_over_and_over(counter, unit):
    text = unit * (200_000 // len(unit))
    read = []
    small = token_counts.Counter(counter.tokenizer, True, chunk=8192, huge=8192)
    plain_heads = small._heads
    small._heads = lambda t, a, b: (read.append(b - a), plain_heads(t, a, b))[1]
    assert small.counts([text]) == library_counts(counter, [text])
    assert sum(read) < (1.2 if unit != "日本語" else 2.5) * len(text)


def test_token_counts_query(spark, docs, counter):
    rows, df = docs
    got = token_counts.count_tokens(df.withColumn("n_tokens", F.lit("old")), tokenizer_file("byte_bpe_50k.json"), limit=50)
    want = Counter((i, len((t or "").encode()), n, n > 50) for (i, t), n in zip(rows, library_counts(counter, [t or "" for _, t in rows]), strict=True))
    assert Counter(tuple(r) for r in got.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()) == want
    assert token_counts.count_tokens(df.limit(0), tokenizer_file("byte_bpe_50k.json")).count() == 0


def test_other_tokenizers_are_encoded_whole(texts):
    other = token_counts.Counter.load(tokenizer_file("word_bpe_49k.json"))
    assert not other.stable and other.counts(texts) == library_counts(other, texts)


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.Codec.load(tokenizer_file("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))


def test_codec_has_parity_with_the_library(codec, library, texts):
    ids = codec.encode(texts)
    want = library.encode(texts)
    assert [i.tolist() for i in ids] == want
    assert codec.decode(ids) == library.decode(want)
    assert [e.ids for e in codec.tokenizer.encode_batch(texts, add_special_tokens=False)] == want
    assert [codec.tokenizer.decode(i) for i in want] == library.decode(want)


def test_decoding_of_any_ids(codec, library):
    rng = random.Random(1)
    import numpy as np

    ids = [[rng.randint(0, 31999) for _ in range(30)] for _ in range(50)] + [[rng.randint(3, 258) for _ in range(20)] for _ in range(50)]
    ids = [[i for i in row if i > 2] for row in ids]
    mine = codec.decode([np.array(i, np.int32) for i in ids])
    # Broken byte runs may be replaced by a different number of marks; all else must be equal.
    assert [re.sub("�+", "�", t) for t in mine] == [re.sub("�+", "�", t) for t in library.decode(ids)]


def test_unigram_models(tmp_path):
    """A small unigram model written by hand, with byte fallback: same ids as the library."""
    import struct

    import sentencepiece

    def field(n, kind, data):
        head = bytes([n << 3 | kind]) if n < 16 else bytes([(n << 3 | kind) & 0x7F | 0x80, (n << 3 | kind) >> 7])
        if kind == 2:
            size, out = len(data), b""
            while size > 127:
                out += bytes([size & 0x7F | 0x80])
                size >>= 7
            return head + out + bytes([size]) + data
        return head + data

    def piece(text, score, kind):
        return field(1, 2, field(1, 2, text.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, bytes([kind])))

    data = piece("<unk>", 0, 2) + piece("<s>", 0, 3) + piece("</s>", 0, 3)
    data += b"".join(piece(f"<0x{b:02X}>", 0, 6) for b in range(256))
    for k, text in enumerate(["▁the", "▁a", "▁", "t", "h", "e", "he", "an", "n", "a", "▁▁", "at", "tt"]):
        data += piece(text, -1.5 - 0.37 * k, 1)
    trainer = field(3, 0, b"\x01") + field(35, 0, b"\x01")
    data += field(2, 2, trainer) + field(3, 2, field(1, 2, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x00") + field(5, 0, b"\x01"))
    path = tmp_path / "unigram.model"
    path.write_bytes(data)
    theirs = sentencepiece.SentencePieceProcessor(model_file=str(path))
    mine = sentencepiece_codec.Codec.load(str(path))
    texts = ["the  heat", "a tan", "", "  the", "then é", "x", "the\nhe", "ant the\nhe"]
    got, want = [i.tolist() for i in mine.encode(texts)], theirs.encode(texts)
    assert got[:-1] == want[:-1]
    assert mine.decode(mine.encode(texts)) == theirs.decode(theirs.encode(texts))
    # "ant": two segmentations whose float32 scores the library's float32 sums cannot tell apart. The rule here is the
    # greater sum in double precision; the library's choice is as good but for float32 rounding.
    scores = [s for _, s, _ in mine.model.pieces]
    mine_sum, their_sum = (sum(scores[i] for i in ids) for ids in (got[-1], want[-1]))
    assert mine_sum >= their_sum and mine_sum - their_sum < 1e-6
    options = [["▁a", "n", "t"], ["▁", "an", "t"]]
    best = max(options, key=lambda o: sum(theirs.get_score(theirs.piece_to_id(p)) for p in o))
    assert got[-1][:3] == [theirs.piece_to_id(p) for p in best]


def test_codec_query(spark, docs, library):
    rows, df = docs
    path = tokenizer_file("piece_bpe_32k.model")
    coded = sentencepiece_codec.decode_ids(sentencepiece_codec.encode_texts(df.withColumn("ids", F.lit(1)), path), path)
    want = Counter((i, tuple(library.encode(t or "")), t or "") for i, t in rows)
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in coded.select("doc_id", "ids", "decoded").collect()) == want
    assert sentencepiece_codec.encode_texts(df.limit(0), path).count() == 0
    lists = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.decoded for r in sentencepiece_codec.decode_ids(lists, path).collect()] == [None, ""]


def test_memo_is_bounded():
    asked = []

    def compute(strings):
        asked.extend(strings)
        return [len(s) for s in strings]

    memo = Memo(10, longest=5)
    for k in range(200):
        found = memo.lookup({"often", str(k), "x" * 9}, compute)
        assert found["often"] == 5 and found["x" * 9] == 9 and len(memo.young) + len(memo.old) <= 16
    assert asked.count("often") == 1




def test_ranking_of_hashes():
    rng = np.random.default_rng(4)
    for n, bits in ((0, 56), (1, 56), (5000, 56), (5000, 5)):
        values = rng.integers(0, 1 << bits, n, dtype=np.uint64)
        # Equal numbers, and numbers that differ in their lowest bits alone.
        values[n // 2 :] = values[: n - n // 2] ^ (np.arange(n - n // 2, dtype=np.uint64) % np.uint64(3))
        order, ranked = words.ranking(values, bits)
        assert (order == np.argsort(values, kind="stable")).all() and (ranked == np.sort(values)).all()
        for got, want in zip(words.distinct(values, bits), np.unique(values, return_inverse=True), strict=True):
            assert (got == want).all()


def test_word_hashes_follow_their_formula(monkeypatch):
    monkeypatch.setattr(words, "_BLOCK", 64)
    data = np.frombuffer(b"a bc  " * 40 + b"x" * 300 + b" bc a", np.uint8)
    starts, ends, _ = words.word_bounds(data, np.array([0, len(data)]), words.WHITE)
    want = []
    for lo, hi in zip(starts.tolist(), ends.tolist(), strict=True):
        want.append(sum(int(words._BYTE[b]) * pow(int(words._STEP), i, 1 << 64) for i, b in enumerate(data[lo:hi].tolist())) % (1 << 64))
    assert (words.word_hashes(data, starts, ends) == words.mix(np.array(want, np.uint64))).all()


def test_language_model_sends_only_what_is_read(spark, monkeypatch):
    sent = []
    plain = kneser_ney.per_chunk_with
    monkeypatch.setattr(kneser_ney, "per_chunk_with", lambda chunks, told, *rest: (sent.append(set(told.columns)), plain(chunks, told, *rest))[1])
    rows = spark.createDataFrame([(1, "a b a"), (2, "b a c"), (3, None)], "doc_id long, text string")
    assert kneser_ney.score_texts(rows, F.col("doc_id") == 2, 3).count() == 3
    assert sent[:2] == [{"shard", "_chunk", "level", "owner", "count"}] * 2 and "owner" not in sent[2] and len(sent) == 3
