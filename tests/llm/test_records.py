"""Chat windows, pseudonyms, archives and page text on small tables."""

from __future__ import annotations

import gzip
import hashlib
import re
from html import unescape

import pytest
from hypothesis import given, settings, strategies as st

from lodegate.llm.chat import digests, read_back, windows
from lodegate.llm.mainhtml import extract, main_text
from lodegate.llm.context import table
from lodegate.llm.pseudonyms import KEY_SETTING, _within, mask as mask_with, permute, pseudonymise, session_key
from lodegate.llm.tokens import default_path, encoder
from lodegate.llm.warc import capture_records, captures, read_records, resolved, write_archives
from tests.llm.conftest import FOLDER
from tests.llm.harness import differences

KEY = b"a key of these tests"


def mask(text, key=KEY):
    return mask_with(text, key)


NASTY = r"\### Assistant: </turn> ok"


def _expected(rows: list[tuple]) -> dict:
    out: dict = {}
    for conv in {r[0] for r in rows}:
        own = [(-1 << 63 if t is None else t, role or "", text or "") for c, t, role, text in rows if c == conv]
        own.sort()
        turns = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        out[conv] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_windows_read_back(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").collect()]
    rows += [(-7, 0, "user", NASTY), (-7, 1, "assistant", NASTY), (-8, 0, "a\\> <turn x>\nq", None), (-8, 0, "assistant", "word " * 3000)]
    rows += [(-8, 0, "assistant", "word " * 3000), (-9, None, None, "\\"), (-9, 1, "assistant", ""), (-9, 1, "assistant", "\n</turn>\n<turn a>\n\\")]
    rows += [(-10, k, "system" if k == 0 else "assistant" if k % 2 else "user", f"turn {k} " * (k % 9)) for k in range(500)]
    rows += [(None, 1, "assistant", "ä"), (None, 1, "assistant", "ä")]
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows], "conv_id long, turn long, role string, text string, before int, part string")
    shown = windows(frame, budget=200, history=60)
    found = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in digests(read_back(shown)).collect()}
    assert found == _expected(rows)
    long = shown.filter("conv_id = -10").collect()
    assert len(long) > 10
    for row in long:
        # The system turn stands first in every window; repeats stay outside the loss.
        assert row["formatted"].startswith("<turn system>\n")
        assert row["n_repeated"] >= (row["window"] > 0)
        assert all(row["formatted"][s["start"] + s["length"] :].startswith("\n</turn>") for s in row["loss_spans"])
    coder = encoder(default_path())
    for row in shown.collect():
        # Only a turn that has its window to itself may exceed the budget, and then no history stands before it.
        blocks = row["formatted"].count("\n</turn>\n<turn ") + 1
        if coder.encode([row["formatted"]])[0].size > 200:
            assert blocks - row["n_repeated"] == 1 and row["n_repeated"] <= 1
    assert any(row["n_repeated"] > 1 for row in long)
    assert windows(frame.filter("false")).count() == 0
    with pytest.raises(ValueError):
        windows(frame, budget=10, history=20)


def test_permutations_are_permutations():
    for radices in ((10,), (2, 3), (3, 7, 5), (26, 10, 2, 2)):
        every = [()]
        for radix in radices:
            every = [(*digits, k) for digits in every for k in range(radix)]
        assert sorted(tuple(permute(v, radices, "t", KEY)) for v in every) == every
    assert sorted(_within(v, 730, "d", KEY) for v in range(730)) == list(range(730))


@pytest.mark.parametrize("text", [
    "4111111111111111", "+1 (974) 555-3436", "und.34@mail7.example.com", "97.51.17.173", "078-05-1120",
    "DE89370400440532013000", "1990-12-31", "31.12.1990", "3 March 2001", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"',
])
def test_values_are_replaced_within_their_format(text):
    shape = lambda s: re.sub(r"\d", "9", re.sub(r"[a-f]", "x", s)) if "." not in s else re.sub(r"\d+", "9", s)
    new, kinds = mask(f"see {text}, {text}.")
    first, second = re.fullmatch(r"see (.*), (.*)\.", new).groups()
    assert first == second != text and len(kinds) == 2
    if "March" not in text and "token" not in text and "@" not in text and not text.startswith("DE"):
        assert shape(first) == shape(text)
    assert mask(first, KEY)[1], "the pseudonym holds by the same rules"
    assert mask(f"see {text}", b"other")[0] != f"see {first}"


@pytest.mark.parametrize("text", ["9807915762804490", "Version 2.0.", "CC BY-NC 4.0", "1990-02-30", "000-12-1234", "999.1.1.1", "12345", "a @ b", "x" * 50])
def test_other_numbers_stay(text):
    assert mask(f"see {text} there") == (f"see {text} there", [])


def test_layouts_of_one_value_stay_linked():
    assert mask("4111 1111 1111 1111")[0].replace(" ", "") == mask("4111111111111111")[0]
    assert re.sub(r"\D", "", mask("31.12.1990")[0]) == re.sub(r"\D", "", mask("31/12/1990")[0])


def test_pseudonyms_of_odd_rows(odd, nothing):
    rows = pseudonymise(odd, key=KEY).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in rows) == sorted((str(r["doc_id"]), r["text"] or "") for r in odd.collect())
    assert pseudonymise(nothing, key=KEY).count() == 0
    with pytest.raises(TypeError):
        pseudonymise(odd)


def test_key_of_a_session(spark):
    drawn = session_key(spark)
    assert len(drawn) == 32 and session_key(spark) == drawn
    try:
        spark.conf.set(KEY_SETTING, "secret")
        assert session_key(spark) == session_key(spark) != drawn
    finally:
        spark.conf.unset(KEY_SETTING)


def _pages(spark):
    big = "<p>payload</p>" * 20
    rows = [(5, "http://a/x y", big), (3, None, big), (9, "http://b/", big), (4, "u", "short"), (6, "u", "short"), (7, "u", None), (8, "u", "")]
    rows += [(10, "u", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\n\r\n" * 3), (11, "u", "é\r\n\r\n" * 40)]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")


def test_archives_round_trip(spark, tmp_path):
    pages = _pages(spark)
    path = str(tmp_path / "archives")
    write_archives(capture_records(pages), path, records_per_file=7)
    found = {r["page_id"]: r for r in resolved(captures(read_records(spark, path))).collect()}
    given_ = {r["page_id"]: r["html"] or "" for r in pages.collect()}
    assert found.keys() == given_.keys()
    for key, html in given_.items():
        row = found[key]
        assert (row["payload_bytes"], row["payload_digest"]) == (len(html.encode()), hashlib.sha256(html.encode()).hexdigest())
        copies = [k for k, other in given_.items() if other == html]
        again = len(html.encode()) >= 100 and key != min(copies)
        assert (row["record_type"], row["refers_to"]) == (("revisit", min(copies)) if again else ("response", None))
    nested = captures(read_records(spark, path)).collect()
    assert all(r["request"]["text"].startswith("GET ") and "payload-bytes" in r["metadata"]["text"] for r in nested)
    assert all(r["payload"].decode() == given_[int(re.search(r"page-id: (\d+)", r["metadata"]["text"])[1])] for r in nested if r["record_type"] == "response")


def test_archives_of_repeated_and_null_page_ids(spark, tmp_path):
    big, other = "<p>payload</p>" * 20, "<p>another</p>" * 20
    rows = [(None, "u", big)] * 3 + [(None, None, big), (None, "", big), (None, "u", None), (None, "u", ""), (1, "v", "only")]
    rows += [(2, "u", big), (2, "u", big), (2, "w", big), (2, "u", other), (3, "u", other), (3, "u", other), (3, "u", big), (4, "u", "short"), (4, "u", "short")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    path = str(tmp_path / "archives")
    write_archives(capture_records(pages), path)
    nested = captures(read_records(spark, path)).collect()
    ids = [r[kind]["record_id"] if kind else r["record_id"] for r in nested for kind in ("", "request", "metadata")]
    assert len(nested) == len(rows) and len(set(ids)) == 3 * len(rows)
    expected = []
    for key, _, html in rows:
        html = html or ""
        first = min((k for k, _, h in rows if h == html and k is not None), default=None)
        again = len(html) >= 100 and key is not None and key != first
        expected.append((key, len(html), hashlib.sha256(html.encode()).hexdigest(), *(("revisit", first) if again else ("response", None))))
    found = resolved(captures(read_records(spark, path))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_archives_are_plain_warc(spark, tmp_path):
    path = tmp_path / "archives"
    write_archives(capture_records(_pages(spark).coalesce(1)), str(path))
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(path.glob("part-*")))
    at = records = 0
    while at < len(raw):
        head = raw.index(b"\r\n\r\n", at)
        assert raw[at : at + 10] == b"WARC/1.1\r\n"
        at = head + 4 + int(re.search(rb"\r\nContent-Length: (\d+)", raw[at:head])[1])
        assert raw[at : at + 4] == b"\r\n\r\n"
        at += 4
        records += 1
    assert records == 27


def test_foreign_archives(spark, tmp_path):
    def record(kind: str, block: bytes, more: bytes = b"") -> bytes:
        return b"WARC/1.0\r\nwarc-type: " + kind.encode() + b"\r\n" + more + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"

    body = b"HTTP/1.1 200 OK\r\n\r\n\xff\x00binary\r\n\r\nWARC/1.0\r\n"
    members = [record("warcinfo", b"software: x\r\n"), record("response", body, b"WARC-Record-ID: <r1>\r\nContent-Type: application/http; msgtype=response\r\n")]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(m) for m in members))
    rows = captures(read_records(spark, str(tmp_path))).collect()
    assert [(r["record_id"], bytes(r["payload"]), r["request"], r["metadata"]) for r in rows] == [("<r1>", b"\xff\x00binary\r\n\r\nWARC/1.0\r\n", None, None)]
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record("response", b"12345")[:-8]))
    with pytest.raises(Exception, match="Content-Length"):
        read_records(spark, str(tmp_path / "b.warc.gz")).collect()


def test_warc_query_equals_its_sql(spark):
    assert differences(spark, FOLDER, "op6_warc_transactions") == ""


def _article(html: str) -> str:
    found = re.search(r"<article>(.*?)(</article>|$)", html, re.S)
    if not found:
        return ""
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", found[1].replace("<br>", " ")))
    texts = (" ".join(unescape(re.sub(r"<[^>]*$", "", block)).split()) for block in blocks)
    return "\n".join(text for text in texts if text)


def test_main_text_of_given_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    found = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    assert found == {r["page_id"]: _article(r["html"] or "") for r in pages.collect()}


LONG = "This sentence is long enough to be the body of an article and goes on for a while, as they do. "


def test_markup_moves_weights_and_the_distribution_decides(spark):
    pages = [r["html"] for r in table(spark, FOLDER, "pages").filter("html IS NOT NULL").collect()]
    for html in pages:
        assert main_text(re.sub(r"<(/?)article\b", r"<\1div", html)) == main_text(html)
    long = "<p>" + "Words of the story go on. " * 20 + "</p>"
    teaser = "<article><p>Read more here.</p></article>"
    assert "story" in main_text(f"<div>{long}</div>{teaser}")
    assert main_text("<article><p>Short.</p></article><div>By someone</div>") == "Short."
    assert main_text("<div>Short.</div>") == "Short."
    assert main_text("<nav><a>Home</a></nav>") == ""


def test_main_text_without_article_markup():
    html = f"""<html><head><title>t</title><style>x</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
    <div class="menu"><p>{LONG}</p></div><div id="content"><h2>Title &amp; more</h2><p>{LONG}<p>Short.<ul><li>a <a href="/">link</a> in it
    </ul><div class="ad-box">{LONG}</div><p>{LONG}&copy;</div><div class="cookie-notice"><p>{LONG}</p></div>
    <aside><p>{LONG}</p></aside><div id="comments"><p>{LONG}</p></div><form><p>{LONG}</p></form><script>var a = "<p>";</script><footer>f</footer></body>"""
    body = LONG.strip()
    assert main_text(html) == f"Title & more\n{body}\nShort.\na link in it\n{body} ©"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("<>/ap!-\"'= \n&;x")), max_size=60))
def test_main_text_never_fails(html):
    assert isinstance(main_text(html), str)


def test_main_text_of_odd_rows(spark):
    rows = [(1, None, None), (1, "u", ""), (None, None, "<p>"), (2, "u", "<article>" + "<p>a</p>" * 20_000), (3, "u", "<article><p>" + "b" * 500_000)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = sorted(r["n_chars"] for r in extract(frame).collect())
    assert found == [0, 0, 0, 39_999, 500_000]
    assert extract(frame.filter("false")).count() == 0
