import zlib

import numpy as np
import pyarrow as pa
import xxhash
from llm.conftest import awkward_rows

from arrivo.llm import packing, token_orc
from arrivo.llm.tokens import encoder, tokenizer_path


def plain_ids(text):
    """The library on the whole text, then the end id."""
    return encoder(tokenizer_path()).tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_ids_equal_the_library():
    texts = ["", "  x ", "́a Éé \x1c b c 's it's DON'T 12%%", "J̌ İ K", "<|endoftext|>x y<|endoftext|>"] + [r[1] or "" for r in awkward_rows()]
    ids, starts = encoder(tokenizer_path())(pa.array(texts))
    assert [list(ids[a:b]) for a, b in zip(starts[:-1], starts[1:])] == [plain_ids(t) for t in texts]


def test_encoder_forgets_but_stays_right(monkeypatch):
    from arrivo.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_WORDS", 5)
    one = tokens.Encoder(tokenizer_path())
    for text in ["a b c d", "c d e f g h", "a b i", "a"]:
        ids, _ = one(pa.array([text]))
        assert list(ids) == plain_ids(text)


def text_hash(text):
    """Spark's xxhash64 of a text, as a signed number; a null leaves the seed."""
    if text is None:
        return 42
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def by_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, text_hash(r[1])))


def test_orc_round_trip(awkward, nothing, spark, tmp_path):
    path = str(tmp_path / "ids")
    token_orc.write_ids(awkward, path)
    got = sorted((r.start, -1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in token_orc.digest(token_orc.read_ids(spark, path)).collect())
    want, at = [], 0
    for doc_id, text, *_ in by_order(awkward_rows()):
        ids = plain_ids(text)
        want.append((at, -1 if doc_id is None else doc_id, len(ids), crc(ids)))
        at += len(ids)
    assert got == want
    token_orc.write_ids(nothing, str(tmp_path / "none"))
    assert token_orc.digest(token_orc.read_ids(spark, str(tmp_path / "none"))).count() == 0


def test_orc_files_prune_by_id(awkward, spark, tmp_path):
    from pyarrow import orc

    path = str(tmp_path / "ids")
    token_orc.write_ids(awkward, path)
    one = token_orc.read_ids(spark, path).where("doc_id = 7")
    assert one.count() == 1
    plan = one._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in plan
    file = next((tmp_path / "ids").glob("*.orc"))
    assert orc.ORCFile(str(file)).compression == "ZSTD"


def test_decomposition():
    sizes = np.array([0, 1, 2, 3, 2047, 2048, 2049, 6000])
    lengths, number = packing.decompose(sizes)
    parts = np.split(lengths, np.cumsum(number)[:-1])
    for size, part in zip(sizes, parts):
        assert part.sum() == size and all(p & (p - 1) == 0 and p <= 2048 for p in part.tolist())
        assert list(part) == sorted(part, reverse=True)
        assert len(part) == size // 2048 + bin(size % 2048).count("1")


def check_packed(rows, docs):
    """Pieces tile their documents, sequences hold one piece each, numbers run without gaps by bucket."""
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    assert all(r.offset == 0 and len(r.ids) == r.length and r.length & (r.length - 1) == 0 and r.length <= 2048 for r in rows)
    by_number = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
    assert by_number == sorted(by_number, reverse=True)
    pieces = sorted((-1 if r.doc_id is None else r.doc_id, r.start, tuple(r.ids), r.doc_tokens) for r in rows)
    want = []
    for doc_id, text, *_ in docs:
        ids, at = plain_ids(text), 0
        lengths, _ = packing.decompose(np.array([len(ids)]))
        for n in lengths.tolist():
            want.append((-1 if doc_id is None else doc_id, at, tuple(ids[at : at + n]), len(ids)))
            at += n
    assert pieces == sorted(want)


def test_packing(awkward, nothing):
    check_packed(packing.pack(awkward).collect(), awkward_rows())
    assert packing.pack(nothing).count() == 0 and packing.digest(packing.pack(nothing)).count() == 0


def test_packing_digest(awkward):
    packed = packing.pack(awkward)
    want = sorted((r.sequence_id, crc(r.ids)) for r in packed.collect())
    assert sorted((r.sequence_id, r.ids_crc32) for r in packing.digest(packed).collect()) == want
