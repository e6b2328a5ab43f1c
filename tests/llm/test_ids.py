"""Token ids as files."""

import json
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sondeo.llm import id_files, queries, simple8b, tokens


@pytest.mark.parametrize("kind", ["tokens", "small", "zeros", "large", "escapes", "mixed", "edges"])
def test_words_come_back(kind):
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 59, 60, 61, 255, 256, 257, 5000):
        values = {
            "tokens": lambda n: np.minimum(rng.zipf(1.3, n), 50_256),
            "small": lambda n: rng.integers(0, 2, n),
            "zeros": lambda n: np.zeros(n, int),
            "large": lambda n: rng.integers(0, 2**32, n),
            "escapes": lambda n: rng.integers(2**60, 2**64, n, dtype=np.uint64),
            "mixed": lambda n: np.where(rng.random(n) < 0.1, rng.integers(2**60, 2**64, n, dtype=np.uint64), rng.integers(0, 999, n).astype(np.uint64)),
            "edges": lambda n: rng.choice(np.array([2**b - 1 for b in range(65)] + [2**b for b in range(64)], dtype=np.uint64), n),
        }[kind](n).astype(np.uint64)
        cuts = np.sort(rng.integers(0, n + 1, 3))
        lengths = np.diff(np.concatenate([[0], cuts, [n]])).astype(np.int64)
        counts = simple8b.block_counts(lengths)
        assert counts.sum() == n and (counts > 0).all() and (counts <= simple8b.BLOCK).all()
        words, by_block = simple8b.encode(values, counts)
        assert by_block.sum() == len(words) and (simple8b.decode(words, by_block, counts) == values).all()
        ends = np.cumsum(by_block)
        for i in rng.integers(0, len(counts), 3) if len(counts) else ():  # a block alone
            a = int(counts[:i].sum())
            assert (simple8b.decode(words[ends[i] - by_block[i] : ends[i]], by_block[i : i + 1], counts[i : i + 1]) == values[a : a + counts[i]]).all()


def greedy(values):
    """Words of one block, one after the other."""
    out, i = [], 0
    while i < len(values):
        for s, n in enumerate(simple8b.COUNTS):
            some = values[i : i + n]
            if all(v < 1 << 60 // n for v in some):
                out.append(s << 60 | sum(v << k * (60 // n) for k, v in enumerate(some)))
                i += n
                break
        else:
            out += [15 << 60, values[i]]
            i += 1
    return out


def test_words_are_those_of_the_greedy_choice():
    rng = np.random.default_rng(2)
    for _ in range(50):
        values = [int(x) >> int(rng.integers(0, 64)) for x in rng.integers(0, 2**64, int(rng.integers(1, 257)), dtype=np.uint64)]
        words, _ = simple8b.encode(np.array(values, np.uint64), np.array([len(values)]))
        assert words.tolist() == greedy(values)
    with pytest.raises(ValueError):
        simple8b.decode(np.array([14 << 60], np.uint64), np.array([1]), np.array([1]))


def plain(texts):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(queries.vocabulary())
    return [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_are_those_of_tokenizers_on_any_text():
    rng = np.random.default_rng(3)
    parts = [" ", " ", " ", "  ", "   ", "\n", "\t", "\r\n", " ", " ", "\x1c", "\x85", "a", "the", "don't", "'s", "I'LL", "ñ", "漢字", "12", "3.5", "!", "...", "é", "é", "👍", "<|endoftext|>", "<|", "\x00", "​", "A" * 40]
    texts = ["".join(rng.choice(parts, int(rng.integers(0, 14)))) for _ in range(6000)]
    encode = tokens.encoder(queries.vocabulary())
    for a in range(0, len(texts), 1000):
        assert [x.tolist() for x in encode(texts[a : a + 1000])] == plain(texts[a : a + 1000])
    assert encode([]) == []


def test_ids_are_those_of_tokenizers_on_the_table_and_on_long_runs(spark, monkeypatch):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += [c * 1_000_000 for c in (" ", "\n", "a", "7", "-", "a ", " \n")]
    encode = tokens.encoder(queries.vocabulary())
    monkeypatch.setattr(tokens, "MEMO_BYTES", 10_000)
    for a in range(0, len(texts), 300):
        assert [x.tolist() for x in encode(texts[a : a + 300])] == plain(texts[a : a + 300])


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    assert not tokens.split_at_spaces(json.loads(Tokenizer.from_file(path).to_str()))
    text = "Some  WORDS here , and\nthere"
    assert tokens.encoder(path)([text])[0].tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


ROWS = [(7, "seven words are in this text of mine"), (-3, None), (1, ""), (None, "no id"), (2, "<|endoftext|> x"), (2, "twice"), (2, "twice"), (10**15, "ñandú 漢字 👍 " * 300), (5, " " * 5000), (8, "x" * 3000)]


@pytest.mark.parametrize("small", [False, True])
def test_files_hold_all_documents_in_order(spark, docs, tmp_path, monkeypatch, small):
    if small:  # a file for each batch, slabs and reads of a block
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
        monkeypatch.setattr(id_files, "FILE_IDS", 1)
        monkeypatch.setattr(id_files, "AT_ONCE", 300)
    try:
        id_files.write_ids(docs(ROWS), queries.vocabulary(), str(tmp_path / "ids"), 50_256)
        back = id_files.read_ids(spark, str(tmp_path / "ids")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = sorted(((i, tuple(ids + [50_256])) for (i, _), ids in zip(ROWS, plain([t or "" for _, t in ROWS]), strict=True)), key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted(back, key=lambda r: r.start)
    assert [r.doc_id for r in got] == [i for i, _ in want] and sorted((r.doc_id or 0, tuple(r.ids)) for r in got) == sorted((i or 0, x) for i, x in want)
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        at += r.n_tokens
    listed = json.loads((tmp_path / "ids" / "manifest.json").read_text())["files"]
    assert sum(f["docs"] for f in listed) == len(ROWS) and sorted(p.name for p in (tmp_path / "ids").glob("*.s8b")) == sorted(f["file"] for f in listed)
    as_bytes = id_files.read_ids(spark, str(tmp_path / "ids"), ["ids", "start"], binary=True).select("start", F.crc32("ids").alias("crc")).collect()
    assert {r.start: r.crc for r in as_bytes} == {r.start: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got}
    with pytest.raises(Exception, match="holds ids already"):
        id_files.write_ids(docs(ROWS), queries.vocabulary(), str(tmp_path / "ids"))


def test_no_documents(spark, docs, tmp_path):
    id_files.write_ids(docs(ROWS).where("false"), queries.vocabulary(), str(tmp_path / "ids"))
    assert id_files.read_ids(spark, str(tmp_path / "ids")).count() == 0


def test_what_is_not_such_a_file_is_told(spark, docs, tmp_path):
    folder = tmp_path / "ids"
    id_files.write_ids(docs(ROWS), queries.vocabulary(), str(folder))
    for p in folder.glob("*.s8b"):
        whole = p.read_bytes()
        p.write_bytes(whole[:-3])
        with pytest.raises(ValueError):
            list(id_files.read_file(*id_files._store(str(p))))
        p.write_bytes(whole[: -id_files.TRAILER_BYTES - 1] + b"\xff" + whole[-id_files.TRAILER_BYTES :])
        with pytest.raises(ValueError, match="damaged"):
            list(id_files.read_file(*id_files._store(str(p))))


def test_failed_tasks_leave_no_files(spark, docs, tmp_path):
    rows = id_files.token_ids(docs(ROWS).repartition(1).orderBy(F.desc("doc_id")), queries.vocabulary(), 0)
    spark.dataSource.register(id_files.TokenIds)
    with pytest.raises(Exception, match="ascending"):
        rows.coalesce(1).write.format(id_files.NAME).mode("append").save(str(tmp_path / "ids"))
    assert not (tmp_path / "ids" / "manifest.json").exists()


def test_query_against_plain_ids(spark):
    got = {r.doc_id: r for r in queries.queries()["op11_token_ids"](spark, "/root/testdata/sf0.001").collect()}
    rows = sorted(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    at = 0
    for row, ids in zip(rows, plain([r.text or "" for r in rows]), strict=True):
        coded = np.array(ids + [0], "<u4")
        assert (got[row.doc_id].start, got[row.doc_id].n_tokens, got[row.doc_id].ids_crc32) == (at, len(coded), zlib.crc32(coded.tobytes()))
        at += len(coded)
    assert len(got) == len(rows)


def test_parts_are_looked_up_once_a_lot(monkeypatch):
    """However often texts have a part; and lots, small memories and lots without any parts change no ids."""
    looked_up = []
    ids_of = tokens._Table.ids_of
    monkeypatch.setattr(tokens._Table, "ids_of", lambda self, known, *a: (looked_up.append(len(known)), ids_of(self, known, *a))[1])
    texts = ["la casa, es de Ana. " * 300 + "fin"] * 20
    assert [x.tolist() for x in tokens.encoder(queries.vocabulary())(texts)] == plain(texts)
    assert looked_up == [9], looked_up
    rng = random.Random(11)
    made = ["".join(rng.choice([*"ab'  \n\n\t\r.,1é×÷ÿɏɐñ \x85\x1c\xa0İß中😀\u0301$", "it's", " a"]) for _ in range(rng.randrange(25))) for _ in range(3000)]
    made += ["", " ", "  ", "a  b", "\n \n", "x\n"]
    for chars, memory in ((1 << 20, 1 << 20), (40, 2000), (1, 1)):
        monkeypatch.setattr(tokens, "LOT_CHARS", chars)
        monkeypatch.setattr(tokens, "MEMO_BYTES", memory)
        assert [x.tolist() for x in tokens.encoder(queries.vocabulary())(made)] == plain(made)


def test_unusual_texts_by_bytes():
    rng = random.Random(12)
    texts = ["".join(rng.choice([*"ab .,\n\t'é×÷ÿɏɐ\x80\xa0İ中😀"] if rng.random() < 0.2 else "abé ,.") for _ in range(rng.randrange(12))) for _ in range(4000)]
    for t in texts:
        data = t.encode()
        assert tokens.unusual_texts(np.frombuffer(data, np.uint8), np.array([0, len(data)])).tolist() == [tokens.UNUSUAL.search(t) is not None], t
    data = [t.encode() for t in texts]
    found = tokens.unusual_texts(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    assert all(odd or not tokens.UNUSUAL.search(t) for odd, t in zip(found, texts, strict=True))
