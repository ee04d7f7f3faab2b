import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from aerocast.llm import bytebpe, packing, pii, wfst

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = {}
    for kind, pattern in BASE.items():
        out[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(p) < 256 for p in m.group().split(".")),
                    "card": 16 <= len(digits) <= 19 and luhn, "phone": 8 <= len(digits) <= 15}[kind]:
                out[kind].append(m.span())
    return out


def test_pii_base_kinds_against_patterns():
    rnd = random.Random(5)
    parts = ["0", "1", "25", "4", "999", ".", ".", "-", " ", "@", "@", "a", "b.c", "+", "(", ")", "é", "4111111111111111", "\n", "٣"]
    for _ in range(30_000):
        t = "".join(rnd.choices(parts, k=rnd.randint(0, 22)))
        got = pii.spans(t)
        assert {k: got[k] for k in BASE} == base_spans(t), t


def test_pii_added_kinds_and_redaction():
    t = "see https://bob:pw@host.example/x, IBAN DE89370400440532013000; account number: 12345-6789, call +1 (555) 010-9999."
    s = pii.spans(t)
    cut = {k: [t[a:b] for a, b in s[k]] for k in s}
    assert cut["url"] == ["https://bob:pw@host.example/x,"] and cut["iban"] == ["DE89370400440532013000"]
    assert cut["account"] == ["DE89370400440532013000", "12345-6789"] and cut["phone"] == ["+1 (555) 010-9999"]
    r = pii.redact(t, s)
    assert "pw" not in r and "DE89" not in r and "12345" not in r and r.endswith("<phone>.")
    assert pii.redact("plain", pii.spans("plain")) == "plain"


def test_pii_dotted_numbers_of_any_length():
    t = "1.2.3." + "9" * 5000 + " 1.2.3.0" + "0" * 5000 + "7 1.2.3.256 10.020.30.255"
    assert [t[s:e].replace("0" * 5000, "") for s, e in pii.spans(t)["ip"]] == ["1.2.3.07", "10.020.30.255"]


def test_pii_query_columns(frame):
    rows = [(1, "a@b.c d@e.org"), (2, None), (3, ""), (1, "a@b.c d@e.org"), (None, "x 1.2.3.4 ü@y.zz " + "pad " * 50_000 + "+49 30 1234567")]
    got = {(r.doc_id, r.pii_email, r.pii_ip, r.pii_phone, r.pii_spans): r.pii_base_sha256 for r in pii.find(frame(rows)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert got[(1, 2, 0, 0, "email:0:5,email:6:13")] == hashlib.sha256(b"email:0:5,email:6:13").hexdigest()
    assert got[(2, 0, 0, 0, "")] == got[(3, 0, 0, 0, "")] == empty and len(got) == 4
    texts = {r.doc_id: r.text for r in pii.find(frame(rows), redacted=True).collect()}
    assert texts[1] == "<email> <email>" and texts[2] is None and texts[3] == "" and texts[None].endswith("<phone>")
    assert pii.find(frame([])).count() == 0


def ids_by_library(path, texts):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(path)
    return [x.ids for x in t.encode_batch_fast(texts, add_special_tokens=False)]


def test_byte_bpe_ids(tokenizer_dir):
    path = f"{tokenizer_dir}/byte_bpe_50k.json"
    rnd = random.Random(6)
    parts = ["a", "the", " ", " ", "  ", "\n", " \n ", "\t", "'s", "it's", "12", "٣", "é", "漢字", "😀", "<|endoftext|>", "--", "\x1c", " ", " "]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(3000)]
    ids = bytebpe.ids_for(path)
    assert [np.frombuffer(ids.encode(t), "<u4").tolist() for t in texts] == ids_by_library(path, texts)


def test_ids_of_many_texts_at_once(tokenizer_dir):
    """Cuts on the bytes of all texts together: each text's own ids, also
    beside other white space, special tokens and nulls."""
    path = f"{tokenizer_dir}/byte_bpe_50k.json"
    rnd = random.Random(16)
    parts = ["a", "the", " ", " ", "  ", "\n", "\u00a0", "\u2003", "\u0085", "\u3000", "é", "ß", "漢字", "<|endoftext|>", "don't", "7", " x "]
    texts = [None, ""] + ["".join(rnd.choices(parts, k=rnd.randint(0, 30))) for _ in range(2000)] + [None, " ", "end "]
    flat, off = bytebpe.ids_for(path).encode_all(pa.array(texts, pa.string()))
    assert [flat[a:b].tolist() for a, b in zip(off, off[1:])] == ids_by_library(path, [t or "" for t in texts])
    sliced = pa.array(texts, pa.string()).slice(100, 50)
    flat, off = bytebpe.ids_for(path).encode_all(sliced)
    assert [flat[a:b].tolist() for a, b in zip(off, off[1:])] == ids_by_library(path, sliced.to_pylist())


def test_many_schemes_cost_no_more_than_their_length():
    import time
    text = "http://" * 60_000 + "user:pw@host"
    t = time.time()
    found = pii.spans(text)
    assert time.time() - t < 20 and found["url"] == [(7 * 59_999, len(text))]
    assert pii.spans("x http://u:p@h/a?b http://none/ ftp://a:b@c|d")["url"] == [(2, 18), (32, 43)]


def test_best_fit_takes_the_tightest_window():
    rnd = random.Random(8)
    sizes = sorted((rnd.randint(1, 64) for _ in range(500)), reverse=True)
    seqs, offsets = packing.best_fit(sizes, 64)
    room = defaultdict(lambda: 64)
    for x, s, o in zip(sizes, seqs, offsets):
        fits = [r for r in room.values() if r >= x]
        assert o == 64 - room[s] if s in room else o == 0 and not fits
        assert not fits or room[s] == min(fits)
        room[s] -= x
    assert min(room.values()) >= 0 and sum(sizes) / (64 * len(room)) > 0.98


def test_packing(frame, tokenizer_dir):
    path = f"{tokenizer_dir}/byte_bpe_50k.json"
    rows = [(1, "word " * 5000), (2, None), (3, ""), (4, "some text"), (4, "some text"), (None, "no id"), (7, "x" * 1023 * 4)]
    got = packing.pack(frame(rows), path, window=64).toPandas()
    want = Counter()
    for (i, t), ids in zip(rows, ids_by_library(path, [t or "" for _, t in rows])):
        ids = [*ids, 0]
        for s in range(0, len(ids), 64):
            part = ids[s:s + 64]
            want[(i, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids))] += 1
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert Counter(tuple(None if x != x else int(x) for x in r) for r in got[cols].astype(float).to_numpy()) == want
    seqs = got.sort_values(["sequence_id", "offset"])
    assert (seqs["offset"] == seqs.groupby("sequence_id")["length"].cumsum() - seqs["length"]).all()
    assert seqs.groupby("sequence_id")["length"].sum().max() <= 64
    assert packing.pack(frame([]), path).count() == 0


def test_transducer_against_library(tokenizer_dir):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = f"{tokenizer_dir}/piece_bpe_32k.model"
    lib, own = sentencepiece.SentencePieceProcessor(model_file=path), wfst.Transducer(path)
    rnd = random.Random(9)
    chars = [chr(x) for x in range(1, 500)] + [" "] * 150 + list("etaoin  ") * 30 + [wfst.MARK, "漢", "😀", "\n"]
    pieces = sorted(own.id)
    for k in range(8000):
        t = "".join(rnd.choices(chars if k % 2 else pieces, k=rnd.randint(0, 20 if k % 2 else 5)))
        ids = own.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(t), t
        assert own.decode(ids) == t.replace(wfst.MARK, " ") == lib.decode(lib.encode(t)), t


def test_encode_and_decode_columns(frame, tokenizer_dir):
    path = f"{tokenizer_dir}/piece_bpe_32k.model"
    rows = [(1, "Ein Text  mit ü\n"), (2, None), (3, ""), (None, "x" * 100_000)]
    out = wfst.decode(wfst.encode(frame(rows), path), path).collect()
    assert {r.doc_id: r.decoded for r in out} == dict(rows)
    assert {r.doc_id: r.piece_ids for r in out}[2] is None
    d = {r.doc_id: r for r in wfst.digests(frame(rows), path).collect()}
    assert all(r.round_trip for r in d.values()) and d[2].n_ids == d[3].n_ids == 0
    assert wfst.digests(frame([]), path).count() == 0
