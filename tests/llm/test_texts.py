"""Operators on single texts against plain versions of the contract."""

from __future__ import annotations

import base64
import collections
import functools
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from herdloom.llm import bpe, decontamination, html_text, language, pii, secrets
from tests.llm.conftest import rows_of

PATH = public_tokenizers.path("byte_bpe_50k.json")
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


# --- secrets -------------------------------------------------------------------------------------


def plain_secrets(text):
    spans = []
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans += [(*m.span(), "assign") for m in re.finditer(pattern, text, re.I | re.A) if len(m[2]) >= 6]
    spans += [(*m.span(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(*m.span(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans, key=lambda s: (s[0], secrets.ORDER[s[2]]))


PIECES = ["Token", "token", "=", " ", ":", "'", '"', "abc123", "==", "password", "PASSWD", "api_key", "apiKEY", "AKIA",
          "ABCDEFGH12345678", "deadbeef", "0123456789abcdef", "\n", "é", "secret", "ſecret", "x", "."]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_base_secrets_equal_plain_search(text):
    assert [s for s in secrets.find(text) if s[2] in secrets.BASE_KINDS] == plain_secrets(text)


def test_tokens_need_their_checksum():
    body = "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5"
    good, bad = f"ghp_{body}{secrets.base62_crc(body)}", f"ghp_{body}AAAAAA"
    assert [s[2] for s in secrets.find(f"x {good} y npm_{body}{secrets.base62_crc(body)}")] == ["github", "npm"]
    assert secrets.find(bad) == []
    assert secrets.base62_crc(body) and zlib.crc32(body.encode()) == sum(
        secrets.BASE62.index(c) * 62**i for i, c in enumerate(reversed(secrets.base62_crc(body)))
    )


def armored(data):
    check = base64.b64encode(secrets.crc24(data).to_bytes(3, "big")).decode()
    body = base64.b64encode(data).decode()
    lines = "\n".join(body[i : i + 64] for i in range(0, len(body), 64))
    return f"{secrets.PGP_BEGIN}\n\n{lines}\n={check}\n{secrets.PGP_END}"


def test_a_key_of_any_length_is_found():
    data = random.Random(1).randbytes(1 << 20)
    block = armored(data)
    assert [s for s in secrets.find(f"é {block} x") if s[2] == "pgp"] == [(2, 2 + len(block), "pgp")]
    assert "pgp" not in {s[2] for s in secrets.find(block.replace(block[5_000], chr(ord(block[5_000]) ^ 1), 1))}


def test_checksum_bit_by_bit():
    for data in (b"", b"a", bytes(range(256)), random.Random(2).randbytes(999)):
        crc = 0xB704CE
        for byte in data:
            for i in range(8):
                bit = (crc >> 23 ^ byte >> (7 - i)) & 1
                crc = (crc << 1 & 0xFFFFFF) ^ (0x864CFB if bit else 0)
        assert secrets.crc24(data) == crc


def test_many_beginnings_take_linear_time():
    block = armored(b"key")
    text = f"{secrets.PGP_BEGIN} x\n" * 40_000 + block
    start = time.process_time()
    assert [s for s in secrets.find(text) if s[2] == "pgp"] == [(len(text) - len(block), len(text), "pgp")]
    assert secrets.find(f"{secrets.PGP_BEGIN} " * 40_000) == []
    assert time.process_time() - start < 10


def test_armored_key_needs_its_checksum():
    data = bytes(range(60))
    check = base64.b64encode(secrets.crc24(data).to_bytes(3, "big")).decode()
    block = f"{secrets.PGP_BEGIN}\nVersion: 1\n\n{base64.b64encode(data).decode()}\n={check}\n{secrets.PGP_END}"
    assert [s[2] for s in secrets.find(block)] == ["pgp"]
    assert secrets.find(block.replace("AAEC", "AAED")) == []


def test_secrets_query_on_edge_rows(edge, none):
    got = rows_of(secrets.find_secrets(edge), "doc_id", "base_sha256", "spans")
    expected = [(r.doc_id, sha(secrets.written(plain_secrets(r.text or ""))), secrets.written(plain_secrets(r.text or ""))) for r in edge.collect()]
    assert got == sorted(expected, key=repr)
    assert secrets.find_secrets(none).count() == 0


# --- byte-pair encoding --------------------------------------------------------------------------


@functools.cache
def library_tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def library():
    return library_tokenizer()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(["<|endoftext|>", "a", "'s", " ", "  ", "\n", "Th", "1²", "é", "\x85", "日", "ing"]), max_size=30).map("".join)))
def test_ids_equal_the_library(text):
    library, own = library_tokenizer(), bpe.tokenizer(PATH)
    ids = own.encode(text)
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_long_runs_and_all_latin_letters(library):
    own = bpe.tokenizer(PATH)
    for text in ("a" * 5_000, "ab" * 3_000, "  " * 500 + "x", "".join(map(chr, range(1, 0x2FF))), "=" * 777):
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_forced_boundaries_cut_no_token():
    own = bpe.tokenizer(PATH)
    assert all(own.fragments_of(token) == [token] for token in own.pieces[:50_256:7] if token)
    assert any(len(own.fragments_of(w.encode())) > 1 for w in ("Öß", "zqxj", "ñÿ", "qzß"))


def test_bpe_queries_on_edge_rows(edge, none, library):
    encoded = bpe.encode_texts(edge, PATH)
    expected = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids) for r in edge.collect()]
    assert rows_of(encoded, "doc_id", "token_ids") == sorted(expected, key=repr)
    assert rows_of(bpe.decode_ids(encoded, PATH)) == rows_of(edge.na.fill("", ["text"]), "doc_id", "text")
    packed = [(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()) for i, ids in expected]
    assert rows_of(bpe.round_trip(edge, PATH), "doc_id", "n_tokens", "ids_sha256") == sorted(packed, key=repr)
    digests = sorted(((r.doc_id, sha(r.text or "")) for r in edge.collect()), key=repr)
    assert rows_of(bpe.round_trip(edge, PATH), "doc_id", "decoded_sha256") == digests
    assert bpe.round_trip(none, PATH).count() == 0


# --- language ------------------------------------------------------------------------------------


def test_language_is_known_for_held_out_documents(small):
    model = language.train(language.training_rows(small))
    held = small.filter("pmod(crc32(cast(doc_id as string)), 4) = 2")
    found = language.identify(held, model).join(held, "doc_id").select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found) and all(0 <= r.score <= 1 for r in found)


def test_code_lengths_equal_a_walk_through_the_contexts(docs):
    train = docs((1, "abracadabra abra", "x"), (3, "cadabra", "x"), (4, "der hund und der mund", "y"))
    model = language.train(train.select("doc_id", "text", "lang"))
    data = {"x": ["abracadabra abra", "cadabra"], "y": ["der hund und der mund"]}

    def bits(lang, context, byte):
        if len(context) == 0:
            lower = 8.0
        else:
            lower = bits(lang, context[1:], byte)
        after = []
        for text in data[lang]:
            padded = b"\n\n\n" + text.encode()
            after += [padded[i] for i in range(3, len(padded)) if padded[i - len(context) : i] == context]
        if not after:
            return lower
        kinds = len(set(after))
        if byte in after:
            return float(np.log2((len(after) + kinds) / after.count(byte)))
        return float(np.log2((len(after) + kinds) / kinds)) + lower

    for text in ("abra", "der abra", "zzz hund"):
        padded = b"\n\n\n" + text.encode()
        expected = [sum(bits(lang, padded[i - 3 : i], padded[i]) for i in range(3, len(padded))) for lang in ("x", "y")]
        assert np.allclose(model.totals([text.encode()])[0], expected, rtol=1e-5)


def test_language_of_edge_rows(edge, none, small):
    model = language.train(language.training_rows(small))
    found = {(r.doc_id, r.lang_pred) for r in language.identify(edge, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "und"), (9, "und")} <= found
    assert language.identify(edge, model).count() == edge.count()
    assert {r.doc_id for r in language.keep_identified(edge, model, 0.5).collect()} <= {None, 5, 6, 7, 8}
    untrained = language.train(none.select("doc_id", "text", "lang"))
    assert {r.lang_pred for r in language.identify(edge, untrained).collect()} == {"und"}
    assert language.identify(none, model).count() == 0


def test_a_text_in_chunks_scores_as_whole(small, monkeypatch):
    model = language.train(language.training_rows(small))
    text = [b"the and of " * 50]
    whole = model.totals(text)
    monkeypatch.setattr(language, "CHUNK", 37)
    assert np.allclose(model.totals(text), whole, rtol=1e-5)


# --- personal data -------------------------------------------------------------------------------


def plain_base(text):
    spans = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append((*m.span(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d[::-1])) % 10 == 0:
            spans.append((*m.span(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            spans.append((*m.span(), "phone"))
    return sorted(spans, key=lambda s: (s[0], pii.ORDER[s[2]]))


PII = ["a", "b.c", "@", "mail", ".", "example.com", "12", "255", "256", "0001", " ", "-", "+1", "(702)", "555", "4111 1111 1111 1111", "378282246310005", "é", "..", "%", "_"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PII), max_size=14).map("".join))
def test_base_spans_equal_plain_search(text):
    assert pii.find_base(text) == plain_base(text)


def revealing_docs(docs):
    rows = [(i, f"filler{i} {w} contact zebulon at jo@x.example.org for news{i}", "en") for i, w in enumerate("abcdefgh")]
    rows += [(100 + i, f"filler{i} contact other{i} at p{i}@y.example.org for news", "en") for i in range(40)]
    return docs(*rows)


def test_terms_that_reveal_an_entity_are_found_and_replaced(docs):
    df = revealing_docs(docs)
    spans = {r.doc_id: r.spans for r in pii.find_personal(df).collect()}
    text = df.filter("doc_id = 0").first().text
    at = text.index("zebulon")
    assert f"term:{at}:{at + 7}" in spans[0] and "term" not in spans[100]
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert "zebulon" not in clean[0] and "jo@x" not in clean[0] and "<EMAIL>" in clean[0]
    assert clean[100] == df.filter("doc_id = 100").first().text.replace("p0@y.example.org", "<EMAIL>")


def test_copies_of_one_context_prove_nothing(docs):
    df = docs(*((i, "contact zebulon at jo@x.example.org now", "en") for i in range(9)))
    assert all("term" not in r.spans for r in pii.find_personal(df).collect())


def test_terms_are_counted_and_replaced_over_whole_documents(docs):
    """A name far from the address goes, a word that the corpus uses elsewhere stays."""
    gap = " ".join(["and so on"] * 60)
    rows = [(i, f"Zebulon {gap} row{i} common mail jo@x.example.org, later {gap} zebulon", "en") for i in range(4)]
    rows += [(100 + i, f"a common word in row{100 + i} without address {gap}", "en") for i in range(60)]
    df = docs(*rows)
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    spans = {r.doc_id: r.spans for r in pii.find_personal(df).collect()}
    for i in range(4):
        assert "ebulon" not in clean[i] and "common" in clean[i] and "and so on" in clean[i] and f"row{i}" in clean[i]
        at = rows[i][1].rindex("zebulon")
        assert {"term:0:7", f"term:{at}:{at + 7}"} <= set(spans[i].split(","))
    assert all(clean[i] == text and spans[i] == "" for i, text, _ in rows[4:])


def test_equal_contexts_in_different_documents_are_evidence(docs):
    signature = "yours sincerely from all of us Zebulon Quill write to jo@x.example.org or come and see us soon"
    rows = [(i, f"letter{i} of word{i} {signature}", "en") for i in range(5)] + [(100 + i, f"text{i} of us all, write or come, see all from us, sincerely yours and soon to be", "en") for i in range(60)]
    clean = {r.doc_id: r.text for r in pii.sanitise(docs(*rows)).collect()}
    assert all("Zebulon" not in clean[i] and "Quill" not in clean[i] and f"letter{i} of word{i} yours sincerely" in clean[i] for i in range(5))


def plain_terms(rows):
    """(doc_id, start, end) of terms that disclose an entity by 90 %, from all pairs of terms and entities."""
    spans, terms, entities = {}, {}, {}
    for doc, text in rows:
        spans[doc] = pii.find_base(text)
        terms[doc] = pii.terms_of(text, spans[doc])
        entities[doc] = {pii.entity_of(text, s) for s in spans[doc]}
    texts_of = dict(rows)
    docs_of, with_term = collections.defaultdict(set), collections.defaultdict(set)
    for doc in texts_of:
        for e in entities[doc]:
            docs_of[e].add(doc)
        for term, _, _ in terms[doc]:
            with_term[term].add(doc)
    n, out = len(rows), set()
    for e, held in docs_of.items():
        ic = math.log(n / len(held))
        for term in {t for doc in held for t, _, _ in terms[doc]}:
            both = held & with_term[term]
            pmi = math.log(n * len(both) / (len(with_term[term]) * len(held)))
            if len({texts_of[d] for d in both}) >= 3 and ic > 0 and pmi >= 0.9 * ic - 1e-12:
                out |= {(doc, a, b) for doc in held for t, a, b in terms[doc] if t == term}
    return out


@pytest.mark.parametrize("seed", range(3))
def test_terms_equal_all_pairs(docs, seed):
    """Random documents with few entities, copies, and terms from very common to rare."""
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(80)]
    weights = [1 / (i + 1) for i in range(80)]
    rows = []
    for i in range(160):
        text = " ".join(rng.choices(words, weights, k=rng.randrange(3, 25)))
        for k in rng.sample(range(12), rng.choice([0, 0, 0, 1, 2, 4])):
            text += f" name{k} of p{k}@x.example.org" + (f" and name{k + 1}" if rng.random() < 0.7 else "")
        rows.append((i, text))
    rows += [(200 + i, text) for i, (_, text) in enumerate(rows[:40])]
    got = set()
    for r in pii.find_personal(docs(*rows)).collect():
        got |= {(r.doc_id, int(a), int(b)) for kind, a, b in (s.split(":") for s in r.spans.split(",") if s) if kind == "term"}
    assert got and got == plain_terms(rows)


def test_a_directory_of_many_entities_and_terms(docs, spark):
    """Three versions of a page of addresses and names: they are one group, and no pairs are spelled out."""
    page = " ".join(f"name{i} p{i}@x.example.org" for i in range(1_500))
    rows = [(i, f"version{i} {page}") for i in range(3)] + [(10 + i, f"other text number{i} with words") for i in range(60)]
    df = docs(*rows)
    found = pii.mentions(df, "doc_id", "text")
    terms, members = pii.revealing(df, found, "text")
    assert members.count() == 1_500 and members.select("entities").distinct().count() == 1 and terms.count() == 1_500
    spans = {r.doc_id: r.spans for r in pii.find_personal(df).collect()}
    assert all(spans[i].count("term:") == 1_500 and spans[10 + i] == "" for i in range(3))


def test_pii_of_edge_rows(edge, none):
    got = rows_of(pii.find_personal(edge), "doc_id", "n_card", "n_phone", "base_sha256")
    expected = []
    for r in edge.collect():
        spans = plain_base(r.text or "") if len(r.text or "") < 10_000 else pii.find_base(r.text)
        kinds = [s[2] for s in spans]
        expected.append((r.doc_id, kinds.count("card"), kinds.count("phone"), sha(pii.written(spans))))
    assert got == sorted(expected, key=repr)
    clean = pii.sanitise(edge)
    assert clean.columns == edge.columns and clean.count() == edge.count() and clean.filter("text is null").count() == 1
    assert pii.find_personal(none).count() == 0 and pii.sanitise(none).count() == 0


# --- decontamination -----------------------------------------------------------------------------


def plain_decontamination(texts, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    for doc, text in texts:
        words, hit, found = cut(text), set(), set()
        for item, item_text in items:
            own = cut(item_text)
            size = min(13, len(own))
            windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
            for i in range(len(words) - size + 1) if own else ():
                if tuple(words[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add(item)
        names = ",".join(sorted(map(str, found)))
        out.append((doc, len(words), len(hit), len(found), sha(names), bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out, key=repr)


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"), (2, "short item"), (3, None),
         (4, ""), (10, "a a a a a a a a a a a a a a a"), (11, "Short  ITEM"), (12, "solo")]


def contaminated_docs(docs):
    long = ITEMS[0][1]
    return docs(
        (1, f"x {long} y"), (2, " ".join(long.split()[:12])), (3, long.upper().replace(" ", "--") + " z" * 600), (4, "a " * 40),
        (5, "b short item short item c"), (6, None), (7, ""), (8, "Solo"), (9, " ".join(long.split()[1:14])), (9, "short, Item"),
    )


@pytest.mark.parametrize("chars", [4_000_000, 60])
def test_search_equals_plain_search(spark, docs, edge, monkeypatch, chars):
    monkeypatch.setattr(decontamination, "SCANNER_CHARS", chars)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    for df in (contaminated_docs(docs), edge.filter("length(text) < 1000 or text is null")):
        got = decontamination.search(df, items)
        columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
        expected = plain_decontamination([(r.doc_id, r.text) for r in df.collect()], ITEMS)
        assert rows_of(got, *columns) == expected
        kept = decontamination.without_contaminated(df, items)
        assert kept.columns == df.columns and kept.count() == sum(not row[-1] for row in expected)


def test_search_of_empty_tables(spark, none, edge):
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.search(edge, items).filter("contaminated or n_hit > 0").count() == 0
    assert decontamination.search(none, items).count() == 0


# --- web pages -----------------------------------------------------------------------------------

PAGES = [
    ("<html><body><nav><a>Menu</a></nav><article><h1>T</h1><p>A &amp; b<br>c</p><p><b>D</article><footer>F</footer>", "T\n\nA & b c\n\nD"),
    ("<article><p>One<aside>ad</aside><p>Two<div class='comments'><p>troll</div><form>f</form></article>", "One\n\nTwo"),
    ("<body><div id=sidebar><p>s s s s</div><div><p>long text of the page</p><p>more</p></div><div class=footer>x</div>", "long text of the page\n\nmore"),
    (None, ""), ("", ""), ("<script>var t='<p>x</p>'</script>", ""), ("a < b and 3 > 2", "a < b and 3 > 2"),
    ("<article><p>x &#233;&nbsp;y &am &copy</p></article", "x é y &am ©"), ("<!-- <p>no</p> --><article>yes</article>", "yes"),
    ("<article><header><h1>H</h1></header>" + "<p>w</p>" * 3_000 + "</article>", "\n\n".join(["H"] + ["w"] * 3_000)),
]


def test_pages(spark):
    df = spark.createDataFrame([(i, "u", h, "x") for i, (h, _) in enumerate(PAGES)], "page_id bigint, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract_pages(df).collect()}
    assert [got[i] for i in range(len(PAGES))] == [(t, len(t)) for _, t in PAGES]


def test_article_of_all_pages(spark):
    import html

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for row in html_text.extract_pages(pages).collect():
        body = re.search("<article>(.*)</article>", source[row.page_id], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", body))
        assert row.text == "\n\n".join(b for b in blocks if b)


PARAGRAPH = "Words of the article that go on and on for quite a while, sentence after sentence, up to its end."


@pytest.mark.parametrize("wrapper", ["<div class='no-sidebar'>", "<div id='content' class='has-sidebar'>", "<div class='header-fixed'>", "<form action=x>"])
@pytest.mark.parametrize("own", ["article", "main", "div"])
def test_marks_of_wrappers_say_nothing(wrapper, own):
    end = wrapper[1 : wrapper.index(" ")]
    page = f"<nav>Home</nav>{wrapper}<{own}><h1>T</h1><p>{PARAGRAPH}</p></{own}><div class='ad'>Buy</div></{end}><footer>F</footer>"
    assert html_text.main_text(page) == f"T\n\n{PARAGRAPH}"


def test_marks_within_an_article():
    page = "<article><div class='entry-header'><h1>T</h1></div><p class='notice'>One</p><p class=related>Two</p><p class=ad>Buy</p></article>"
    assert html_text.main_text(page) == "T\n\nOne\n\nTwo"


def test_comments_and_adverts_are_no_wrappers():
    page = f"<div><p>Short article</p></div><div class='comments'><article>{PARAGRAPH}</article></div><div class='ad'>{PARAGRAPH}</div>"
    assert html_text.main_text(page) == "Short article"


@pytest.mark.parametrize("between", [
    "<div class='ad'><p>a</p><p>b</p><p>c</p></div>", "<div class='share'><ul><li>a<li>b<li>c<li>d</ul></div>",
    "<form><label>Letter</label><p>b</p><p>c</p><button>d</button></form>", "<aside><p>a</p><p>b</p><p>c</p><p>d</p></aside>",
])
def test_an_article_in_plain_divs_goes_on_after_what_stands_in_its_middle(between):
    parts = [f"{PARAGRAPH} {i}" for i in range(3)]
    text = f"Title\n\n{parts[0]}\n\n{parts[1]}\n\n{parts[2]}\n\nEnd."
    first, last = f"<h1>Title</h1><p>{parts[0]}</p>", f"<p>{parts[1]}</p><p>{parts[2]}</p>{between}<p>End.</p>"
    assert html_text.main_text(f"<body><div>{first}{between}{last}</div></body>") == text
    assert html_text.main_text(f"<body>{first}{between}{last}</body>") == text
    assert html_text.main_text(f"<body><div>{first}</div>{between}<div>{last}</div></body>") == text


def test_plain_menus_and_footers_that_touch_the_article_are_no_part_of_it():
    links = "".join(f"<li><a href='/{i}'>A long title of another article, number {i}</a></li>" for i in range(9))
    article = f"<h1>T</h1><p>{PARAGRAPH} 1</p><p>{PARAGRAPH} 2 <a href=x>link</a></p><p>End.</p>"
    menu, footer = "<div>Home</div><div>News</div>", "<div>All rights are with the makers of the page, whoever they may be, now and later on.</div>"
    for page in (f"{menu}<div>{article}</div>{footer}", f"<ul>{links}</ul><div>{article}</div><ul>{links}</ul><div>Imprint</div>"):
        assert html_text.main_text(f"<body>{page}</body>") == f"T\n\n{PARAGRAPH} 1\n\n{PARAGRAPH} 2 link\n\nEnd."


EIGHT = [f"{PARAGRAPH} {i}" for i in range(8)]


@pytest.mark.parametrize("page, text", [
    # A teaser in an article element beside the article, which has none.
    ("<article><p>Teaser one, short.</p></article><div>" + "".join(f"<p>{p}</p>" for p in EIGHT) + "</div>", EIGHT),
    # The article in its element, a long footer beside it.
    ("<article>" + "".join(f"<p>{p}</p>" for p in EIGHT) + f"<p>End.</p></article><div>{PARAGRAPH}</div>", [*EIGHT, "End."]),
    (f"<div><p>{EIGHT[0]}</p><p>{EIGHT[1]}</p></div><div>{EIGHT[2]}</div>", EIGHT[:3]),
    (f"<div><p>{EIGHT[0]}</p><p>{EIGHT[1]}</p></div><div>&copy; {EIGHT[2]}</div>", EIGHT[:2]),
    ("<article><p>See <label>term</label> and <button>x</button> and more text</article>", ["See term and x and more text"]),
    ("<article><p>Let <math><mi>x</mi><annotation>\\x</annotation></math> be</article>", ["Let x be"]),
    (f"<main><ul><li>Home<li>About<li>Contact us</ul><p>{EIGHT[0]}</p><ul><li>One<li><a>two</a></ul><a href=x>Next story</a></main>", [EIGHT[0], "One", "two"]),
    (f"<main><p>{EIGHT[0]}</p><ul><li><a>Home</a><li><a>About</a></ul><button>Like</button><p>End.</p></main>", [EIGHT[0], "End."]),
])
def test_the_distribution_chooses_with_and_without_article_elements(page, text):
    assert html_text.main_text(f"<body>{page}</body>") == "\n\n".join(text)


@given(st.lists(st.integers(0, 120), max_size=40), st.integers(1, 5))
def test_surges_against_plain_window_sums(weights, window):
    windows = [range(i, min(i + window, len(weights))) for i in range(len(weights))]
    total = {w: sum(weights[k] for k in w) for w in windows}
    surge = min(html_text.SURGE, max(total.values(), default=0) / 2)
    expected = [
        i for i, weight in enumerate(weights)
        if weight and weight * window >= surge and any(i in w and total[w] >= surge for w in windows)
    ]
    assert html_text.surging(weights, window) == expected


@pytest.mark.parametrize("piece, end", [("<a ", '"'), ("<div><b>y</b>", ""), ("<a \"x' ", ""), ("<b>", "<p>x</p>" * 20_000), ("</i>", "")])
def test_broken_markup_takes_linear_time(piece, end):
    def seconds(n):
        start = time.process_time()
        html_text.main_text("<p><div>" + piece * n + end)
        return time.process_time() - start

    assert seconds(40_000) < 20 * max(seconds(5_000), 0.02)


def test_blocks_are_fetched_one_at_a_time(docs, spark, monkeypatch):
    """Three blocks and more: none is asked for before the marks of those before it are stored."""
    monkeypatch.setattr(decontamination, "SCANNER_CHARS", 60)
    log, fetch, store = [], decontamination.benchmark_blocks, decontamination.stored

    def fetched(*args):
        for last, block in fetch(*args):
            log.append("fetched")
            yield last, block

    def kept(*args):
        log.append("stored")
        return store(*args)

    monkeypatch.setattr(decontamination, "benchmark_blocks", fetched)
    monkeypatch.setattr(decontamination, "stored", kept)
    items = [(i, f"item{i} has some words of its own") for i in range(9)]
    found = decontamination.search(docs(*((i, f"text {text} end") for i, text in items)), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {r.doc_id: r.item_ids for r in found.collect()} == {i: [str(i)] for i, _ in items}
    assert log.count("fetched") >= 3 and log == (["fetched", "stored"] * len(log))[: len(log)] and log[-1] == "fetched"
