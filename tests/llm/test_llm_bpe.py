import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clicklens.llm import bpe
from clicklens.llm.bpe import Decoder, Encoder, Vocabulary, decode, encode, encoded_and_decoded
from clicklens.llm.queries import op1_bpe_round_trip
from llm_tools import frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def made():
    with open(PATH, "rb") as f:
        v = Vocabulary(f.read())
    return Encoder(v), Decoder(v), Tokenizer.from_file(PATH)


def check(made, texts):
    encoder, decoder, library = made
    for t, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = np.frombuffer(encoder.encode(t), "<i4")
        assert ids.tolist() == want.ids, t[:80]
        assert decoder.decode(ids)[0].tobytes().decode() == library.decode(want.ids, skip_special_tokens=False)


def test_equals_the_library_on_random_texts(made):
    rnd = random.Random(4)
    alphabet = list(" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 　a'stremdlv1é!à.-日😀ſKİ̀​")
    check(made, ["".join(rnd.choices(alphabet, k=rnd.randint(0, 40))) for _ in range(8000)])


def test_equals_the_library_on_every_kind_of_character(made):
    check(made, [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}1!{chr(c)} \n{chr(c)}"
                 for c in [*range(0x20, 0x3000), *range(0x3000, 0x20000, 97)] if not 0xD800 <= c < 0xE000])


def test_special_token_and_long_texts_without_a_cut(made):
    check(made, ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>c", "<|endoftext", "a" * 5000,
                 "thequick" * 700, " " * 3000, "\n \n" * 500, "é" * 3000, "'" * 999, "voilà là à  à"])


def test_forced_boundaries_are_never_merged_across(made):
    v = made[0].v
    piece = "zqxjkvwq".encode()
    whole = v._merged_long([v.single[b] for b in piece])
    ids, number = v.encoded([piece, b"a", piece * 20, b"the"])
    assert ids[:number[0]].tolist() == whole and number.sum() == len(ids)
    assert ids[number[:2].sum():number[:3].sum()].tolist() == v._merged_long([v.single[b] for b in piece * 20])
    held = {bytes([a, b]) for t in v.bytes.values() for a, b in zip(t, t[1:])}
    for a, b in zip(piece, piece[1:]):
        assert v.cut[a, b] == (bytes([a, b]) not in held)


def test_memo_generations_change_nothing(made, monkeypatch):
    monkeypatch.setattr("clicklens.llm.bpe.MEMO_BYTES", 2000)
    small = Encoder(made[0].v)
    rnd = random.Random(8)
    words = ["".join(rnd.choices("abcdeé", k=rnd.randint(1, 9))) for _ in range(300)]
    texts = [" ".join(rnd.choices(words, k=40)) for _ in range(200)]
    got = [x for i in range(0, 200, 7) for x in small.encode_all(texts[i:i + 7])]
    assert got == made[0].encode_all(texts) and small.old and len(small) < 300


def most_bytes(run):
    tracemalloc.start()
    try:
        out = run()
        return tracemalloc.get_traced_memory()[1], out
    finally:
        tracemalloc.stop()


def test_decoding_needs_little_beside_the_text(made):
    ids = np.frombuffer(made[0].encode("the quick brown fox " * 20), "<i4")
    many = np.tile(ids, 6000)
    most, (raw, length) = most_bytes(lambda: made[1].decode(many))
    assert len(raw) == 6000 * 400 and raw.tobytes() == ("the quick brown fox " * 20 * 6000).encode()
    # The text, its ids as 64-bit numbers and their lengths, and a slice's work; before: 24 bytes for each of the text.
    assert most < len(raw) + 16 * len(many) + (16 << 20)


def test_a_batch_of_texts_needs_memory_for_a_block_only(made):
    rnd = random.Random(6)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 9))) for _ in range(500)]
    texts = [" ".join(rnd.choices(words, k=300)) for _ in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    memo = Encoder(made[0].v)

    def run():
        return sum(b.num_rows for b, lists in bpe._encoded(memo, batch, 0) if bpe._texts(made[1], lists).equals(b.column(0)))

    most, rows = most_bytes(run)
    assert rows == len(texts) and batch.nbytes > 6 << 20
    assert most < 48 << 20   # 1 MB blocks: about 25 MB; 8 MB blocks need over 150 MB


def test_query_digests(spark):
    sf = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(back.encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op1_bpe_round_trip(spark, sf).collect()} == want


def test_rows_nulls_clashing_columns_and_repeats(spark):
    df = frame(spark, "doc_id long, text string, ids string, decoded int", [
        (1, "Hello  world", "x", 5), (1, "Hello  world", "x", 5), (2, None, None, None), (None, "", "y", 1)])
    out = encoded_and_decoded(df, PATH)
    assert set(out.columns) == {"doc_id", "ids", "decoded"}
    rows = sorted((r.doc_id or 0, tuple(r.ids), r.decoded) for r in out.collect())
    assert [r[2] for r in rows] == ["", "Hello  world", "Hello  world", ""]
    assert rows[0][1] == () and rows[1] == rows[2]


def test_unknown_and_null_ids_give_nothing(spark):
    df = frame(spark, "ids array<int>", [([15496, None, 10 ** 6, -3],), (None,), ([],)])
    assert sorted(r.decoded for r in decode(df, PATH).collect()) == ["", "", "Hello"]


def test_empty_table(spark):
    df = frame(spark, "doc_id long, text string", [])
    assert encode(df, PATH).count() == 0
    assert encoded_and_decoded(df, PATH).select(F.size("ids")).collect() == []
