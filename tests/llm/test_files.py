import base64
import gzip
import hashlib
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from hazegrid.llm import chat, packing, warc
from hazegrid.llm.common import of_this_worker
from hazegrid.session import scratch_path

TOKENS = public_tokenizers.path("byte_bpe_50k.json")


# ---- WARC

def one(i, payload=b"<html>x</html>"):
    return warc.record(i, f"http://a/{i}", payload, "D", "response", None, "2024-01-01T00:00:00Z")


def ids(data):
    return [(f["warc-record-id"] if f else None) for _, _, f, _, _ in warc.salvage(data)]


def covered(data):
    at = 0
    for offset, length, *_ in warc.salvage(data):
        assert offset >= at
        at = offset + length
    return at


def test_salvage_of_members():
    members = [gzip.compress(one(i, bytes([65 + i]) * 3000), mtime=0) for i in range(5)]
    whole = b"".join(members)
    names = [f"<urn:page:{i}>" for i in range(5)]
    assert ids(whole) == names and covered(whole) == len(whole)
    start = [sum(map(len, members[:i])) for i in range(6)]
    broken = bytearray(whole)
    broken[start[2] + 40] ^= 0xFF                       # the checksum of the third fails
    assert ids(bytes(broken)) == [*names[:2], None, *names[3:]]
    gap = [r for r in warc.salvage(bytes(broken)) if r[2] is None]
    assert [(g[0], g[1]) for g in gap] == [(start[2], len(members[2]))] and gap[0][4]
    assert ids(whole[:-5]) == [*names[:4], None]          # cut off
    assert ids(b"garbage" + whole[:start[1]] + b"\x1f\x8b\x08noise" + whole[start[1]:]) == [None, names[0], None, *names[1:]]
    assert ids(b"") == [] and ids(b"nothing here") == [None] and ids(warc._EMPTY) == []
    assert gzip.decompress(whole + warc._EMPTY) == gzip.decompress(whole)


def test_salvage_of_plain_records():
    records = [one(i, b"text with WARC/1.1 inside") for i in range(4)]
    whole = b"".join(records)
    names = [f"<urn:page:{i}>" for i in range(4)]
    assert ids(whole) == names
    broken = bytearray(whole)
    broken[len(records[0]) + len(records[1]) - 10] ^= 1    # the block digest of the second fails
    assert ids(bytes(broken)) == [names[0], None, *names[2:]]
    wrong = whole.replace(b"Content-Length: ", b"Content-Length: 9", 1)
    assert ids(wrong)[1:] == names[1:]
    assert ids(records[0] + b"junk\r\n" + records[1]) == [names[0], None, names[1]]


def test_salvage_inside_a_member():
    r = np.random.RandomState(1)
    records = [one(i, r.bytes(3000).hex().encode()) for i in range(60)]
    names = [f"<urn:page:{i}>" for i in range(60)]
    content = bytearray(b"".join(records))
    content[len(b"".join(records[:3])) - 10] ^= 1          # the block digest of the third fails, the member is whole
    whole = gzip.compress(bytes(content), mtime=0)
    assert ids(whole) == [*names[:2], None, *names[3:]]
    assert "of the member's content" in [x for x in warc.salvage(whole) if x[2] is None][0][4]
    good = gzip.compress(b"".join(records), mtime=0)
    after = gzip.compress(one(99), mtime=0)
    wrong = bytearray(good)
    wrong[-6] ^= 1                                         # the checksum
    assert ids(bytes(wrong) + after) == [*names, None, "<urn:page:99>"]
    cut = ids(good[:len(good) // 2])                       # its end is missing
    assert cut[:28] == names[:28] and cut[-1] is None and len(cut) < 40
    flipped = bytearray(good)
    flipped[len(good) // 2] ^= 0xFF
    assert ids(bytes(flipped) + after)[:25] == names[:25] and ids(bytes(flipped) + after)[-1] == "<urn:page:99>"


def test_archives_round_trip(spark):
    long = "x<p>é</p>\r\n\r\nWARC/1.1\r\n" * 4000
    pages = [(1, "u", "a"), (2, None, "a"), (3, "u\r\nv", "b"), (4, "u", None), (5, "u", ""), (6, "u", long), (7, "u", long), (7, "u", long),
             (None, "u", "a"), (None, None, None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 AS id", "2 AS digest", "3 AS payload")
    for squeeze in (True, False):
        path = scratch_path(spark, "warc")
        warc.write_archives(warc.deduplicated(df), path, archive_bytes=3000, compress=squeeze)
        read = warc.read_archives(spark, path)
        assert read.where("kind = 'gap'").count() == 0 and read.select("path").distinct().count() > 1
        rows = warc.page_records(read).collect()
        newest = {"a": 2, "": 5, long: 7}
        want = []
        for i, _, html in pages:
            raw = (html or "").encode()
            again = newest.get(html or "", i) != i
            digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
            want.append((i, len(raw), digest, "revisit" if again else "response", newest[html or ""] if again else None))
        assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
        payloads = {r.payload.decode() for r in read.where("fields['warc-type'] = 'response'").collect()}
        assert payloads == {"a", "b", "", long}
    small = warc.deduplicated(df, min_bytes=2)
    assert {r.id: r.record_type for r in small.where("id is not null").collect()}[1] == "response"
    empty = scratch_path(spark, "warc")
    warc.write_archives(warc.deduplicated(df.where("page_id > 99")), empty)
    assert warc.read_archives(spark, empty).count() == 0


# ---- chat

CONVERSATIONS = [(1, 0, "system", "be kind"), (1, 1, "user", "hi <|im_end|>"), (1, 2, "assistant", "<|im_start|>x\\|"), (1, 3, "user", None),
                 (1, 4, "assistant", "bye<\\|"), (1, 5, "user", "ok"), (2, 0, "user", "alone"), (2, 0, "user", "alone"), (3, 0, "assistant", ""),
                 (None, 0, "user", "u"), (None, None, None, "first"), (4, 1, "odd\nrole|\\n", "t"), (4, 2, "assistant", "é中")]


def conversations(spark, rows=CONVERSATIONS):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS n", "2 AS segment")


def test_turns_round_trip(spark):
    formatted = chat.format_turns(conversations(spark))
    out = {r.conv_id: r for r in chat.digests(formatted).collect()}
    for conv in {r[0] for r in CONVERSATIONS}:
        turns = sorted((r[1:] for r in CONVERSATIONS if r[0] == conv), key=lambda t: (-1 if t[0] is None else t[0]))
        said = [(r or "", t or "") for _, r, t in turns]
        loss = "".join(t for r, t in said if r == "assistant")
        r = out[conv]
        assert r.n_turns == len(turns) and r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digests(chat.format_turns(conversations(spark, []))).count() == 0


def test_examples_are_prefixes(spark):
    formatted = chat.format_turns(conversations(spark))
    whole = {}
    for r in sorted(formatted.collect(), key=lambda r: (str(r.conv_id), r.n)):
        assert len(whole.get(r.conv_id, "")) == r.seg_start
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.segment
        assert len(whole[r.conv_id]) == r.seg_end
    texts = chat.example_texts(formatted).collect()
    assert len(texts) == sum(r[2] == "assistant" for r in CONVERSATIONS) == chat.examples(formatted).count()
    for r in texts:
        assert whole[r.conv_id].startswith(r.text) and r.text.endswith("<|im_end|>\n")
        assert r.text[:r.target_start].endswith("<|im_start|>assistant\n")
        said = [t or "" for c, _, role, t in CONVERSATIONS if c == r.conv_id and role == "assistant"]
        assert chat.unescape(r.text[r.target_start:r.target_end]) == said[r.example - 1]
        assert r.text.count("<|im_end|>") == r.text.count("<|im_start|>")


def test_loss_is_read_from_the_expanded_examples(spark):
    rows = CONVERSATIONS + [(9, i, ("user", "assistant")[i % 2], f"é<|{i}|>") for i in range(40)]
    formatted = chat.format_turns(conversations(spark, rows))
    texts = chat.example_texts(formatted, batch_chars=100)
    out = {r.conv_id: r for r in chat.digests(formatted, texts.where("example = 2")).collect()}
    for conv in {r[0] for r in rows}:
        second = "".join([t or "" for c, _, role, t in rows if c == conv and role == "assistant"][1:2])
        assert (out[conv].loss_chars, out[conv].loss_sha256) == (len(second), hashlib.sha256(second.encode()).hexdigest())
    nine = sorted((r for r in texts.collect() if r.conv_id == 9), key=lambda r: r.example)
    assert len(nine) == 20 and all(b.text.startswith(a.text) for a, b in zip(nine, nine[1:])) and out[9].formatted_chars == len(nine[-1].text)


def test_escape_is_reversible(spark):
    texts = ["", "<|", "<\\|", "<\\\\|<|<||>", "a<b|c", "<|im_start|><|im_end|>", "\\", "<\\", "|<", "<\\|\\|"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for raw, safe, role in df.select("t", chat.escape(df.t), chat.escape_role(df.t)).collect():
        assert chat.unescape(safe) == raw and "<|" not in safe
        assert chat.unescape_role(role) == raw and "|" not in role


# ---- packing

def test_pieces_and_places(spark):
    texts = ["hello world " * n for n in (1, 3, 700, 2000, 5)] + ["", None, "x  y\n\nz \t", "<|endoftext|> a<|endoftext|>"] * 3 + ["mid " * k for k in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = packing.pack_documents(df.repartition(3), TOKENS, size=256, block=50, most_docs=256, most_cost=256 ** 2).collect()
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(TOKENS)
    for i, t in enumerate(texts):
        ids = np.array(plain.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        mine = sorted((r for r in out if r.doc_id == i), key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(len(mine))) and sum(r.length for r in mine) == len(ids)
        assert all(r.length == 256 for r in mine[1:]) and mine[0].start == 0
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) for r in mine)
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    whole = sum(r.length for r in out) / 256
    assert len(sequences) <= 1.1 * whole + 1


def test_best_fit_against_a_plain_loop():
    r = np.random.RandomState(0)
    lengths = np.minimum(r.randint(1, 100, 400), 77)
    cap, w = np.array([100.0, 5.0, 6000.0]), np.array([1.0, 0.05, 0.2])
    for rule in ("norm", "dot"):
        where, offset = packing.best_fit(lengths, 100, 5, 6000, rule=rule)
        bins, want, starts = [], np.zeros(400, int), np.zeros(400, int)
        for i in np.argsort(-lengths, kind="stable"):
            n = int(lengths[i])
            need = np.array([n, 1, n * n], float)
            fits = [k for k, b in enumerate(bins) if (b >= need).all()]
            score = {k: float((((bins[k] - need) / cap) ** 2) @ w if rule == "norm" else ((bins[k] / cap) * (need / cap)) @ w) for k in fits}
            k = min(fits, key=lambda k: (round(score[k], 12), k)) if fits else len(bins)
            if not fits:
                bins.append(cap.copy())
            want[i], starts[i] = k, 100 - int(bins[k][0])
            bins[k] = bins[k] - need
        assert (where == want).all() and (offset == starts).all()
        assert all((b >= 0).all() for b in bins) and max(np.bincount(where)) <= 5


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("ab 'Z9\n\t.!中é​\x1c<|>")), st.characters(codec="utf-8")), max_size=40))
def test_word_by_word_ids_are_the_ids_of_the_text(text):
    encoder = test_word_by_word_ids_are_the_ids_of_the_text.__dict__.setdefault("encoder", packing.Encoder(TOKENS))
    assert encoder.encode([text])[0] == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_words_learned_together_and_forgotten(monkeypatch):
    """Words that touch line feeds or nothing, words of many bytes, and a memory that gives up its older half."""
    monkeypatch.setattr(packing, "JOINED", 5)
    monkeypatch.setattr(packing, "REMEMBERED", 40)
    encoder = packing.Encoder(TOKENS)
    texts = ["", " ", "a ", " a", "one\ntwo three\n", "\nfour five\n six", "ünï 中文 😀 ok", "x" * 300 + " y's don't 12,5 (z)", "don't 're é"]
    texts += [" ".join(f"w{i}x{j % 13}" for j in range(30)) for i in range(20)]
    for _ in range(2):
        for at in range(0, len(texts), 4):
            assert encoder.encode(texts[at:at + 4]) == encoder._ids(texts[at:at + 4])
    assert len(encoder.known) < 200
    assert packing.shared_encoder(TOKENS) is packing.shared_encoder(TOKENS)


def test_words_in_use_are_not_learned_again(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 40)
    encoder, learned = packing.Encoder(TOKENS), []
    learn = encoder._learn
    encoder._learn = lambda words: (learned.extend(words), learn(words))[1]
    for i in range(40):
        assert encoder.encode([f"a often used w{i} x{i}"]) == encoder._ids([f"a often used w{i} x{i}"])
        assert len(encoder.known) + len(encoder.older) < 60
    assert learned.count("often") == learned.count("used") == 1


def test_a_worker_holds_one_operators_memory_at_a_time():
    first = of_this_worker("a", dict)
    first["x"] = 1
    assert of_this_worker("a", dict) is first
    assert of_this_worker("b") is None and of_this_worker("b") is None
    assert of_this_worker("a", dict) == {}
