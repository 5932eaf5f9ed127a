"""Words, HTML, packing, contamination, substrings against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from feedlake.llm import decontaminate, html_text, pack, substring_dedup, words as W
from tests.llm.cases import documents, edited, empty, prose, texts


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é\t\n\x0b.9Z", max_size=40), max_size=6))
def test_word_hashes(values):
    data = [v.encode() for v in values]
    for separators, pattern in ((W.WHITE, rb"[^\x20\x09-\x0d]+"), (W.ALNUM, rb"[0-9A-Za-z\x80-\xff]+")):
        hashes, bounds = W.word_hashes(data, separators)
        split = [re.findall(pattern, d) for d in data]
        assert np.diff(bounds).tolist() == [len(s) for s in split]
        flat = [w for s in split for w in s]
        assert [W.word_hashes([w], separators)[0][0] for w in flat] == hashes.tolist()
        assert len(set(hashes.tolist())) == len(set(flat))


def test_words_longer_than_a_chunk():
    text = b"ab " + b"x" * (2 * W.CHUNK + 7) + b" cd " + b"y " * W.CHUNK
    hashes, bounds = W.word_hashes([text, b"", b"cd"], W.WHITE)
    assert np.diff(bounds).tolist() == [3 + W.CHUNK, 0, 1]
    assert hashes[2] == hashes[-1] and hashes[0] == W.word_hashes([b"ab"], W.WHITE)[0][0]


PAGES = [
    ("<nav><a href=x>Menu</a></nav><article><h1>T &amp; t</h1><p>One\n two</p><p><b>Three<br><p>4 &lt;5</article><footer>&copy; f</footer>",
     "T & t\n\nOne two\n\nThree\n\n4 <5"),
    ("<body><header><h1>Site</h1></header><main><header><h2>Head</h2></header><p>Body text.</p><aside>side</aside><form><p>q</p></form>"
     "<div class='comments'><article class=comment><p>reader</p></article></div></main><div class=cookie-notice>We use</div></body>", "Head\n\nBody text."),
    ("<article><script>var a='<p>no</p>';</script><style>p{}</style><p>yes<!-- <p>no</p> --> sir</p><p hidden>no</p></article>", "yes sir"),
    ("<article><p title='a>b'>quoted</p><p>cut &am", "quoted\n\ncut &am"),
    ("plain &eacute;", "plain é"), ("", ""), (None, ""), ("<p>", ""),
    ("<nav><ul><li><a>m</a><article><p>unclosed menu</p></article>", "unclosed menu"),
    ("<div class='sidebar'><p>" + "the of and " * 20 + "</p></div><div><p>" + "This is the story of a man and his dog. " * 5 + "</p><p>Short end.</p></div>",
     " ".join(("This is the story of a man and his dog. " * 5).split()) + "\n\nShort end."),
]


def test_html(spark):
    pages = spark.createDataFrame([(i, f"u{i}", h, "clash") for i, (h, _) in enumerate(PAGES)] + [(0, "u0", PAGES[0][0], "clash")],
                                  "page_id long, url string, html string, text string")
    got = html_text.extract(pages).collect()
    assert Counter((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in got) == Counter(
        [(i, f"u{i}", t, len(t)) for i, (_, t) in enumerate(PAGES)] + [(0, "u0", PAGES[0][1], len(PAGES[0][1]))])
    assert html_text.extract(pages.limit(0)).count() == 0


def test_articles_in_wrappers_with_class_words():
    long = " ".join(("This is the story of a man and his dog. " * 5).split())
    story = f"<header><h1>T</h1></header><p>{long}</p><p>Short end.</p>"
    whole = f"T\n\n{long}\n\nShort end."
    for page in (f"<div class='has-sidebar'><article>{story}</article></div>", f"<div id='content-sidebar-wrap'><main>{story}</main></div>",
                 f"<div class='has-header'><div class=x><main><article>{story}</article></main></div></div>",
                 f"<article class='post comment-open'>{story}</article>",
                 f"<div class=has-sidebar><main>{story}<div class=related><article><p>{long}</p></article></div></main></div>"):
        assert html_text.main_text(page) == whole, page
    # Beside an article, in comments and by element such articles stay out; short blocks alone do not come in.
    for page in (f"<div class=sidebar><article>{story}</article></div><article><p>Own.</p></article>",
                 f"<article><p>Own.</p><div class=related><article>{story}</article></div></article>"):
        assert html_text.main_text(page) == "Own."
    for page in (f"<div class=comments><article>{story}</article></div>", f"<aside class=sidebar><article>{story}</article></aside>",
                 f"<aside><div class=sidebar><article>{story}</article></div></aside>", f"<div class=sidebar>{story}</div>",
                 f"<div class=sidebar><article class=comment>{story}</article></div>", f"<article class=ad>{story}</article>",
                 "<div class=sidebar><article><p>Read this.</p></article></div>", f"<div class=sidebar hidden><article>{story}</article></div>"):
        assert html_text.main_text(page) == "", page


def test_articles_of_the_pages_table(spark):
    import html as h
    from tests.conftest import SF_CHECK
    pages = spark.read.parquet(f"{SF_CHECK}/pages.parquet")
    raw = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in html_text.extract(pages).collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", raw[r["page_id"]], re.S)[1]
        parts = [" ".join(h.unescape(re.sub(r"<[^>]*(>|\Z)", " ", x)).split()) for x in re.split(r"</?(?:p|h1)[^>]*>", article)]
        assert r["text"] == "\n\n".join(p for p in parts if p)


PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["don't can't it's", "ÀÉÎ ß İstanbul ΑΒΓΣ ς", "<|endoftext|> x<|startoftext|>y", "e\u0301 \u0301x A\u030a", "\u2028a\u00a0b\u3000c\x85d", "a\x1cb\x00c",
       "日本語 テスト 12345 ½ ²", "🙂🙂 emoji👍🏽"]


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer
    docs = documents(spark, texts() + ODD)
    tok = Tokenizer.from_file(PATH)
    want = Counter()
    coded = {}
    for r in docs.collect():
        want[r["doc_id"]] += 1
        coded[r["doc_id"]] = np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [1], dtype="<u4")
    for window in (2048, 64):
        got = pack.pack(docs, PATH, window=window).collect()
        pieces = defaultdict(Counter)
        for r in got:
            ids = coded[r["doc_id"]]
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
            pieces[r["doc_id"]].update(range(r["start"], r["start"] + r["length"]))
        assert all(pieces[i] == Counter({k: want[i] for k in range(len(coded[i]))}) for i in want) and set(pieces) == set(want)
        rows = defaultdict(list)
        for r in got:
            rows[r["sequence_id"]].append((r["offset"], r["length"]))
        for own in rows.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= window and (at == window or at & (at - 1) == 0)      # no padding at all
    assert pack.pack(empty(spark), PATH).count() == 0


def test_plain_words_are_coded_together(monkeypatch):
    """Words of letters, accents and capitals included, with punctuation behind them never go to the library one by one."""
    from tokenizers import Tokenizer
    coder, tok, alone = pack.WordTokens(open(PATH, encoding="utf-8").read(), 1), Tokenizer.from_file(PATH), []
    monkeypatch.setattr(coder, "_coded", lambda words, coded=coder._coded: alone.extend(words) or coded(words))
    values = ["École, déjà vu.*** Été! ß? Über;", "Caf\u00e9... ÿ, plain. WORD)"]
    ids, bounds = coder.encode([v.encode() for v in values])
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [
        tok.encode(v, add_special_tokens=False).ids + [1] for v in values]
    assert all(re.fullmatch(rb"[!-/:-@]+", w) for w in alone)


def test_remembered_words_are_those_of_the_tokenizer(monkeypatch):
    """Words around the length that the table holds, zero bytes, tables that grow, a full memory."""
    from tokenizers import Tokenizer
    coder, tok, draw = pack.WordTokens(open(PATH, encoding="utf-8").read(), 1), Tokenizer.from_file(PATH), random.Random(11)
    values = ["a a\0 a\0\0 \0a b", *(" ".join("xyz"[k % 3] * n + c for c in ("", ".", "\0", "é", "é,")) for k, n in enumerate(range(1, 40)))]
    values += [" ".join("".join(draw.choices("abcdé.'", k=draw.randrange(1, 20))) for _ in range(4000)) for _ in range(12)]
    want = [tok.encode(v, add_special_tokens=False).ids + [1] for v in values]
    for memo in (pack.MEMO, 10):
        monkeypatch.setattr(pack, "MEMO", memo)
        for _ in range(2):
            got = []
            for k in range(0, len(values), 7):
                ids, bounds = coder.encode([v.encode() for v in values[k:k + 7]])
                got += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            assert got == want


def test_least_squares_never_overuses():
    draw = np.random.default_rng(3)
    for _ in range(5):
        hist = np.zeros(256, dtype=np.int64)
        hist[1:] = draw.integers(0, 30, 255) * (draw.random(255) < 0.4)
        combos = pack.combinations(256, np.flatnonzero(hist))
        assert all(sum(r * k for r, k in c.items()) == 256 for c in combos)
        used = np.zeros(256, dtype=np.int64)
        for c, x in zip(combos, pack.fit_repeats(hist, combos), strict=True):
            for r, k in c.items():
                used[r] += k * x
        assert (used <= hist).all()


def items():
    draw = random.Random(9)
    some = [t for t in texts() if t and len(t.split()) > 40]
    take = [" ".join(t.split()[5:5 + n]) for t, n in zip(some, (30, 12, 10, 9, 25, 3, 1), strict=False)]
    return take + [prose(draw, 40), "", None, "...", take[0], "One! TWO", "é"]


@pytest.mark.parametrize("block", [500_000, 10])
def test_contamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    docs = documents(spark, repeat_rows=block > 10)
    bench = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(items())], "item_id long, text string, doc_id string")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for i, t in enumerate(items()):
        w = word.findall((t or "").translate(low))
        for k in range(max(1, len(w) - 9)) if w else []:
            windows[tuple(w[k:k + 10])].add(str(i))
    want = Counter()
    for r in docs.collect():
        w, hit, found = word.findall((r["text"] or "").translate(low)), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in windows:
                    found |= windows[tuple(w[k:k + size])]
                    hit |= set(range(k, k + size))
        want[(r["doc_id"], len(w), len(hit), len(found), ",".join(sorted(found)), bool(hit))] += 1
    got = decontaminate.contamination(docs, bench)
    rows = got.collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], ",".join(r["items"]), r["contaminated"]) for r in rows) == want
    for r in rows:                               # matches are the longest: each covers its spans
        assert (r["n_hit"] > 0) == bool(r["matches"]) and {m["item"] for m in r["matches"]} == set(r["items"])
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter({k[0]: n for k, n in want.items() if not k[5]})
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, none).where("contaminated").count() == 0
    assert decontaminate.contamination(empty(spark), bench).count() == 0


def test_rows_with_shared_ids_are_judged_alone_in_several_blocks(spark, monkeypatch):
    parts = [" ".join(f"{c}{i}" for i in range(12)) for c in "ab"]
    values = [(None, "clean"), (None, parts[0]), (None, None), (7, "clean too"), (7, parts[0] + " x " + parts[1]), (8, parts[1]), (8, parts[1])]
    docs = spark.createDataFrame(values, "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(parts)), "item_id long, text string")
    want = Counter({(None, 1, 0, (), 0): 1, (None, 12, 12, ("0",), 1): 1, (None, 0, 0, (), 0): 1, (7, 2, 0, (), 0): 1,
                    (7, 25, 24, ("0", "1"), 2): 1, (8, 12, 12, ("1",), 1): 2})
    for block in (500_000, 4):
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
        assert len(list(decontaminate.test_blocks(bench, 10, "item_id", "text"))) == (1 if block > 4 else 2)
        got = decontaminate.contamination(docs, bench).collect()
        assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), len(r["matches"])) for r in got) == want


def test_covers():
    for period, cover in substring_dedup.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("window", [13, 5, 2])
def test_substrings(spark, monkeypatch, window):
    monkeypatch.setattr(substring_dedup, "CHUNK_ROWS", 16)      # several chunks and groups
    monkeypatch.setattr(substring_dedup, "GROUP_HASHES", 256)
    draw = random.Random(5)
    values = texts() + [edited(draw, t, 2) for t in texts() if t and len(t) > 200][:20]
    docs = documents(spark, values)
    rows = [(r["doc_id"], (r["text"] or "").encode().split()) for r in docs.collect()]
    first = {}
    for i, w in rows:
        for k in range(len(w) - window + 1):
            first[tuple(w[k:k + window])] = min(i, first.get(tuple(w[k:k + window]), i))
    want = Counter()
    for i, w in rows:
        gone = {k + j for k in range(len(w) - window + 1) if first[tuple(w[k:k + window])] < i for j in range(window)}
        want[(i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode())] += 1
    got = substring_dedup.remove_repeats(docs, window=window).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == want
    assert all(sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"] for r in got)
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0


def test_null_ids_never_remove(spark):
    text = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(None, text), (5, text), (None, text)], "doc_id long, text string")
    got = {(r["doc_id"], r["n_removed"]) for r in substring_dedup.remove_repeats(docs).collect()}
    assert got == {(None, 20), (5, 0)}
    assert hashlib.sha256(b"").hexdigest()
