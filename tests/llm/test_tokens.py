import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as public
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from veilspark.llm import bpe, pieces, token_files

ALPHABET = [" ", "\n", "\t", "\x85", "\xa0", chr(0x2003), chr(0x2028), chr(0x3000), "\x1c", *"   ab's1!é", "日本", "\U0001d518", "<|endoftext|>"]
random.seed(11)
ODD = ["", " ", "a  b", " x ", "word " * 3000, *("".join(random.choices(ALPHABET, k=random.randint(0, 20))) for _ in range(1500))]


@pytest.fixture(scope="module")
def codec():
    path, pattern = bpe.default_vocabulary()
    return bpe.codec(bpe.read_ranks(path), pattern)


@pytest.fixture(scope="module")
def library():
    path, pattern = bpe.default_vocabulary()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_encodes_as_the_library(codec, library):
    ids, ends = codec.batches.encode(pa.array(ODD))
    assert [ids[a:z].tolist() for a, z in zip(ends, ends[1:], strict=False)] == [library.encode_ordinary(t) for t in ODD]


def test_transducer_is_bpe(codec):
    small = bpe.Transducer(codec.transducer.ranks, most_states=50)  # forgets all the time
    for _ in range(800):
        piece = bytes(random.choices(b"abcdetinghs \xc3\xa9", k=random.randint(1, 40)))
        want = [small.ranks[piece]] if piece in small.ranks else [small.ranks[t] for t in small.merges(piece)]
        assert small.encode(piece) == want == codec.transducer.encode(piece)


def test_memo_that_is_full_all_the_time(codec):
    small = pieces.BatchEncoder(codec._encode, most=20)
    for at in range(0, 400, 20):
        ids, ends = small.encode(pa.array(ODD[at : at + 20]))
        want = codec.batches.encode(pa.array(ODD[at : at + 20]))
        assert ids.tolist() == want[0].tolist() and ends.tolist() == want[1].tolist()


def test_stream_decoding_in_any_blocks():
    text = "aé日\U0001d518" * 50
    raw = text.encode()
    for size in range(1, 9):
        stream = bpe.Utf8Stream()
        assert "".join(stream.feed(raw[i : i + size]) for i in range(0, len(raw), size)) == text
        stream.end()
    for bad in (b"\xff", b"\xc0\x80", b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b"\x80", b"\xe2\x28"):
        with pytest.raises(UnicodeDecodeError):
            bpe.Utf8Stream().feed(bad + b"    ")
    cut = bpe.Utf8Stream()
    cut.feed(b"\xe2\x82")
    with pytest.raises(UnicodeDecodeError):
        cut.end()


def test_round_trip(spark, library):
    rows = [(i, t, 1) for i, t in enumerate(ODD[:300])] + [(7, None, 1), (None, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = bpe.round_trip(df, *bpe.default_vocabulary()).collect()

    def want(i, t):
        ids = library.encode_ordinary(t or "")
        return (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())

    assert sorted(map(str, map(tuple, got))) == sorted(str(want(i, t)) for i, t, _ in rows)
    ids = bpe.encode(df.limit(5), *bpe.default_vocabulary()).collect()
    assert all(r.ids == library.encode_ordinary(ODD[r.id]) for r in ids)
    assert bpe.round_trip(df.limit(0), *bpe.default_vocabulary()).count() == 0


def test_parts_encode_as_whole_texts():
    use = token_files.Encoder(token_files.read_tokenizer(public.path("byte_bpe_50k.json")))
    texts = [*ODD, None, "a <|endoftext|> b", "  <|endoftext|>  ", "x\ue000 y  z", "\ue000", "é" * 5000, "one two  three " * 2000, ODD[10], ODD[10]]
    for some in (texts, texts[:1], ["a b"], []):
        ids, ends = use.encode(pa.array(some, pa.string()))
        want = [x.ids for x in use.library.encode_batch([t or "" for t in some], add_special_tokens=False)]
        assert [ids[a:z].tolist() for a, z in zip(ends, ends[1:], strict=False)] == want
    assert use.encode(pa.array(["a <|endoftext|> b"]))[0].tolist() == [64, 220, 50256, 275]


@pytest.mark.parametrize("n", [0, 1, 400])
def test_token_files(spark, tmp_path, n):
    rows = [(i * 37 % 1009, t) for i, t in enumerate(ODD[:n])] + ([(None, None)] if n else [])
    df = spark.createDataFrame([(i, t, "p") for i, t in rows], "doc_id long, text string, path string").repartition(3)
    folder = f"file://{tmp_path}/t"
    manifest = token_files.write(df, public.path("byte_bpe_50k.json"), folder, length=64, rows=4)
    got = token_files.read_documents(manifest, folder).collect()
    library = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    start, want = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    stream = []
    for f in manifest.orderBy("part").collect():
        file = token_files.SequenceFile(pa.memory_map(f.path))
        for k in range(len(file)):
            ids, mask = file[k]
            assert len(ids) == len(mask) == 64 and ids.dtype == np.uint16
            stream += ids[np.array(mask.to_pylist(), bool)].tolist()
    assert len(stream) == start
