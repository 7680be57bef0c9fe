"""URL filter, archive and chat formatting."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tickmart.llm import chat, url_filter, warc

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.net", "/en/x", "block"), ("example.com", "", "block"),
         ("a.example.com", "/ok", "allow"), ("both.org", "/", "allow"), ("both.org", "/", "block")]
URLS = ["http://example.net/en/1", "http://m.EXAMPLE.net/en/xyz?q#h", "https://example.net/de", "http://x.net", "http://x.net?/en",
        "http://example.com", "http://a.example.com/okay/1", "http://notexample.com/", "http://b.a.example.com/o", "no scheme", None, "",
        "://", "http://both.org/p", "http://example.net/en", "http://net/", "x://é.net/É#://", "http://example.net:80/en/", "http://a\n.net/\n"]


def brute(url):
    if url is None or "://" not in url:
        host, path = "", ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h), len(p), v, h + p) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else None
    return host, path, best[3] if best else None, best[2] if best else "allow"


@pytest.mark.parametrize("limit", [url_filter.TRIE_RULES, 2])
def test_url_rules(spark, limit):
    pages = spark.createDataFrame([(i, u, "x", "y", "z") for i, u in enumerate(URLS)] + [(0, URLS[0], "x", "y", "z")],
                                  "page_id bigint, url string, host string, rule string, verdict string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = sorted((r.page_id, (r.host, r.path, r.rule, r.verdict)) for r in url_filter.judge(pages, rules, trie_rules=limit).collect())
    assert got == sorted([(i, brute(u)) for i, u in enumerate(URLS)] + [(0, brute(URLS[0]))])


@pytest.mark.parametrize("limit", [url_filter.TRIE_RULES, -1])
def test_url_rules_of_nothing(spark, limit):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id bigint, url string")
    assert [tuple(r) for r in url_filter.judge(pages, none, trie_rules=limit).collect()] == [(1, "a.b", "/c", None, "allow")]
    assert url_filter.judge(pages.limit(0), none, trie_rules=limit).collect() == []


def test_archive_round_trip(spark, tmp_path):
    big, other = "ü" * 60, "<p>" + "b" * 200
    rows = [(3, "http://a/1", big), (1, "http://a/2", big), (2, None, big), (4, "u\r\nv%0A", other), (5, "u", "short"), (6, "u", "short"),
            (7, "u", None), (8, "u", ""), (9, "u", other), (9, "u", other), (None, "u", big), (10, "w", "WARC-Type: revisit\r\n\r\n" * 9)]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, url string, html string, digest string, holder string")
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path)
    back = warc.read_archive(spark, path).collect()
    key = lambda t: tuple(map(str, t))
    assert sorted(((r.page_id, r.url, bytes(r.payload).decode()) for r in back), key=key) == sorted(((i, u, h or "") for i, u, h in rows), key=key)
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in back)
    assert kinds == sorted([("1", "response", None), ("2", "revisit", 1), ("3", "revisit", 1), ("None", "revisit", 1), ("4", "response", None),
                            ("5", "response", None), ("6", "response", None), ("7", "response", None), ("8", "response", None),
                            ("9", "revisit", 4), ("9", "revisit", 4), ("10", "response", None)])
    assert all(r.payload_digest == hashlib.sha256(bytes(r.payload)).hexdigest() and r.payload_bytes == len(r.payload) for r in back)
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h in rows})
    record = next(bytes(r.record) for r in warc.read_records(spark, path).collect() if b"Record-ID: <urn:page:1>" in bytes(r.header))
    head, _, body = record.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response") and body == big.encode() + b"\r\n\r\n"


def test_archive_repeats_one_page_and_nothing(spark, tmp_path):
    same = spark.createDataFrame([(1, "u", "x" * 100)] * 3, "page_id bigint, url string, html string")
    warc.write_archive(same, str(tmp_path / "a"))
    assert sorted(r.record_type for r in warc.read_archive(spark, str(tmp_path / "a")).collect()) == ["response", "revisit", "revisit"]
    warc.write_archive(same.limit(0), str(tmp_path / "b"))
    assert warc.read_archive(spark, str(tmp_path / "b")).collect() == []


def test_archive_finds_a_damaged_payload(spark, tmp_path):
    warc.write_archive(spark.createDataFrame([(1, "u", "x" * 100)], "page_id bigint, url string, html string"), str(tmp_path / "a"))
    bad = spark.read.parquet(str(tmp_path / "a/payloads")).withColumn("payload", F.lit(b"y"))
    bad.write.parquet(str(tmp_path / "b/payloads"))
    spark.read.parquet(str(tmp_path / "a/headers")).write.parquet(str(tmp_path / "b/headers"))
    with pytest.raises(Exception, match="does not match"):
        warc.read_archive(spark, str(tmp_path / "b")).collect()


CHATS = [(1, 0, "user", "a<b \\l \\ </turn>\n<turn>x"), (1, 1, "assistant", "\\b<turn>assistant\nno\\"), (1, 2, "assistant", ""), (2, 0, "us\ner<", None),
         (3, 1, None, "x"), (3, 1, "assistant", "é\U0001f600"), (None, None, "assistant", "null"), (4, 0, "assistant", "long " * 20000),
         (5, 0, "user", "same"), (5, 0, "user", "same")]


def test_chat_round_trip(spark):
    turns = spark.createDataFrame([(*r, "x", "y") for r in CHATS], "conv_id bigint, turn bigint, role string, text string, place string, piece string")
    shaped = chat.formatted(turns.withColumn("parts", chat.text_part(F.col("text"))))
    got = {r.conv_id: r for r in chat.digests(shaped).collect()}
    assert set(got) == {c[0] for c in CHATS}
    for conv, r in got.items():
        own = sorted(((t, role or "", text or "") for c, t, role, text in CHATS if c == conv), key=lambda x: (x[0] or 0, x[1], x[2]))
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in own).encode()).hexdigest()
        loss = "".join(b for _, a, b in own if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digests(chat.formatted(turns.limit(0).withColumn("parts", chat.text_part(F.col("text"))))).collect() == []


def test_chat_parts(spark):
    turns = spark.sql("""SELECT 1L conv_id, 0L turn, 'user' role, array(named_struct('kind','text','text','see <','ref',null,'units',null),
        named_struct('kind','image','text',null,'ref','i.png','units',3L), named_struct('kind','audio','text','ignored','ref',null,'units',null), null,
        named_struct('kind',null,'text',' two words','ref',null,'units',9L)) parts
        UNION ALL SELECT 1L, 1L, 'assistant', array(named_struct('kind','document','text',null,'ref','d.pdf','units',2L),
        named_struct('kind','text','text','ok','ref',null,'units',null)) UNION ALL SELECT 1L, 2L, 'user', null""").selectExpr(
        "conv_id", "turn", "role", f"cast(parts as {chat.PARTS}) parts")
    row = chat.formatted(turns).collect()[0]
    assert row.formatted == ("<turn>user\nsee \\l<image 1><audio 2> two words</turn>\n<turn>assistant\n<document 3>ok</turn>\n<turn>user\n</turn>\n")
    assert [tuple(a) for a in row.attachments] == [(1, "image", "i.png", 768), (2, "audio", None, 25), (3, "document", "d.pdf", 1024)]
    assert row.tokens == 2 + 768 + 25 + 2 + 1024 + 1
    start, length = row.loss[0]
    assert row.formatted[start:start + length] == "<document 3>ok"
