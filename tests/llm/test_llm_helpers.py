"""Pure functions of the training-data operators against brute force."""

import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from lakeops.llm import html_extract, license_scan, near_dedup, packing, quality_classifier, quality_rules, token_output
from lakeops.llm.registry import TOKENIZER
from lakeops.llm import tokens
from lakeops.llm.tokens import WordIds, token_ids


def test_token_ids_equal_the_tokenizers_own():
    from tokenizers import Tokenizer
    t, w = Tokenizer.from_file(TOKENIZER), WordIds(TOKENIZER)
    texts = ["", " ", "The cat's 12 tails, isn't it?\n\tYes!!", "É è   x́ ́y Straße 𝔘 ŒUF", "a" * 5000,
             "don't we'll I'M <|endoftext|> x<|endoftext|>y", "A <|ENDOFTEXT|> b. c,d ,e ... f... g.\x1c", "a.\xa0b.\nc.",
             "w." * 3000, "Q" * 200 + " x " + "ab.c " * 10, "Δοκιμή ΣΑΣ. 中文字 1234 ½", "\x1c a\x85b c", "İI ſtop. The, THE."]
    r = random.Random(2)
    letters = "aAbé ÉİßΣ.,'!\n\t\x0b 中9½-\u0301\x1c\x85\u2028s<|endoftext|>"
    texts += ["".join(r.choice(letters) for _ in range(r.randrange(40))) for _ in range(3000)]
    want = [t.encode(x, add_special_tokens=False).ids + [0] for x in texts]
    assert [x.tolist() for x in token_ids(texts, w, 0)] == want
    assert [x.tolist() for x in token_ids([None, "", None], w, 0)] == [[0]] * 3
    assert max(map(len, w)) <= tokens.MAX_CACHED_WORD


def test_token_ids_outlive_a_full_cache_and_take_other_tokenizers(monkeypatch):
    from tokenizers import Tokenizer
    monkeypatch.setattr(tokens, "MAX_CACHE", 40)
    t, w = Tokenizer.from_file(TOKENIZER), WordIds(TOKENIZER)
    for k in range(20):
        texts = [" ".join(f"word{i}" for i in range(k * 7 + j, k * 7 + j + 30)) for j in range(3)]
        assert [x.tolist() for x in token_ids(texts, w, None)] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    path = public_tokenizers.path("byte_bpe_50k.json")
    t, w = Tokenizer.from_file(path), WordIds(path)
    texts = ["Two  spaces and Capitals.", " x\n\ny", ""]
    assert not w.worded and [x.tolist() for x in token_ids(texts, w, None)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def brute_repeats(words):
    seen = Counter(zip(words, words[1:], words[2:]))
    return len({i + k for i in range(len(words) - 2) for k in range(3) if seen[tuple(words[i:i + 3])] > 1})


def test_text_counts_against_brute_force():
    r = random.Random(3)
    for _ in range(300):
        words = [r.choice("abc") for _ in range(r.randrange(0, 30))]
        text = "".join(w + r.choice([" ", "\n", "\t \n"]) for w in words)
        n = quality_rules.text_counts(text)
        lines = [x for x in text.split("\n") if x.strip(" \t")]
        assert n == (len(words), len(words), 0, len(lines), len(lines) - len(set(lines)), brute_repeats(words))
    assert quality_rules.text_counts(None) == (0,) * 6
    assert quality_rules.text_counts("a#b $ é")[:3] == (2, 6, 2)


def test_best_two_fit_places_every_piece_once_without_overlap():
    r = random.Random(5)
    for _ in range(40):
        cap = r.choice([10, 64, 300])
        counts = Counter(r.randint(1, cap) for _ in range(r.randrange(0, 400)))
        plan = packing.best_two_fit(counts, cap)
        bins, ranks = {}, {}
        rows = sorted(zip(plan.length, plan.rank, plan.each, plan.sequence, plan.offset))
        for i, (n, rank, each, seq, off) in enumerate(rows):
            last = rows[i + 1][1] if i + 1 < len(rows) and rows[i + 1][0] == n else counts[n]
            for k in range(rank, last):
                at = k - rank
                bins.setdefault(seq + at // each, []).append((off + at % each * n, n))
                ranks[n] = ranks.get(n, 0) + 1
        assert ranks == dict(counts)
        assert sorted(bins) == list(range(plan.n_sequences))
        for members in bins.values():
            end = 0
            for off, n in sorted(members):
                assert off == end
                end += n
            assert end <= cap
        least = -(-sum(n * c for n, c in counts.items()) // cap)
        assert plan.n_sequences <= max(least * 1.25 + 1, 1)


def test_two_fit_replaces_the_smallest():
    # greedy takes 6 + 3 of 10; 2 + 2 fill the gap of 4 exactly
    plan = packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10)
    first = {n: e for n, e, s in zip(plan.length, plan.each, plan.sequence) if s == 0}
    assert first == {6: 1, 2: 2} and plan.n_sequences == 2


def test_best_fit_decreasing_is_best_fit():
    r = random.Random(9)
    for _ in range(60):
        cap = r.choice([8, 31, 100])
        lengths = [r.randint(0, cap) for _ in range(r.randrange(0, 120))]
        bins = token_output.best_fit_decreasing(lengths, cap)
        rooms = []
        for k in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fit = [x for x in rooms if x >= lengths[k]]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - lengths[k])
            else:
                rooms.append(cap - lengths[k])
        assert sorted(k for b in bins for k in b) == list(range(len(lengths)))
        assert sorted(cap - sum(lengths[k] for k in b) for b in bins) == sorted(rooms)


def test_similarity_is_probability_jaccard():
    r = np.random.default_rng(1)
    for _ in range(50):
        a, b = (dict(zip(r.choice(30, 12, replace=False).tolist(), r.integers(1, 4, 12).tolist())) for _ in "ab")
        want = sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in {*a, *b}) for d in a if d in b)
        x, y = sorted(a), sorted(b)
        got = near_dedup.similarity(np.array(x, np.uint64), np.array([a[i] for i in x]),
                                    np.array(y, np.uint64), np.array([b[i] for i in y]))
        assert got == pytest.approx(want)
    one = np.arange(10, dtype=np.uint64)
    assert near_dedup.similarity(one, np.ones(10), one + np.uint64(5), np.ones(10)) == pytest.approx(5 / 15)


def test_signatures_estimate_the_similarity():
    r = np.random.default_rng(2)
    for n, w in ((1, 1), (40, 1), (400, 3)):
        a = np.unique(near_dedup.mix(r.integers(0, 2 ** 62, n).astype(np.uint64)))
        b = np.unique(np.concatenate([a[: int(len(a) * 0.9)], near_dedup.mix(r.integers(0, 2 ** 62, n // 10).astype(np.uint64))]))
        if not len(b):
            b = a
        wa, wb = r.integers(1, w + 1, len(a)), r.integers(1, w + 1, len(b))
        s = near_dedup.signatures([a, b, np.zeros(0, np.uint64)], [wa, wb, np.zeros(0, int)])
        assert (s[0] == s[1]).mean() == pytest.approx(near_dedup.similarity(a, wa, b, wb), abs=0.15)
        assert set(s[0].tolist()) <= set(a.tolist())


def test_license_scan_words_and_spans():
    s = license_scan.Scanner()
    assert s.scan(None) == (0, 0, None, None, "", "", 0.0, [])
    n, base, first, last, labels, every, score, spans = s.scan("x É CC--BY-NC 4.0; All\nRIGHTS reserved. cc by")
    assert (n, base, first, last, labels, score) == (12, 3, 2, 10, "cc-by,reserved", 1.0)
    assert s.scan("accc by")[1] == 0 and s.scan("cc byé")[1] == 0 and s.scan("K cc by")[1] == 1
    typo = s.scan("foo bar Relased under the MIT Licens and more")
    assert typo[1] == 0 and typo[5] == "mit" and 0 < typo[6] < 1
    assert [(x["label"], x["first_word"], x["last_word"]) for x in typo[7]] == [("mit", 2, 6)]
    assert s.scan("nothing to see " * 50)[5] == ""
    far = s.scan("word " * 100_000 + "licensed under the apache license version 2.0")
    assert far[5] == "apache" and far[7][0]["first_word"] == 100_000


def test_fuzzy_search_misses_no_match_within_the_edits():
    import regex
    r = random.Random(4)
    n = license_scan.Notice("t", "released under the mit license", 2)
    s = license_scan.Scanner((n,), {})
    whole = regex.compile(rb"(?<![^ ])(?:" + n.text.encode() + rb"){e<=2}(?![^ ])")
    for _ in range(150):
        t = list(n.text)
        for _ in range(r.randrange(0, 5)):
            i = r.randrange(len(t))
            t[i:i + 1] = r.choice([[], [r.choice("abcxyz")], [t[i], r.choice("abcxyz")]])
        text = license_scan.normal("lorem " + "".join(t) + " ipsum")
        assert bool(s.fuzzy(text)) == bool(whole.search(text))


def test_license_scan_finds_neighbouring_notices():
    s = license_scan.Scanner()
    worse, best = "released under the mit licence ", "released under the mit license "
    for text, edits in ((worse + best, [1, 0]), (best + worse, [0, 1]), (worse + worse + best + worse, [1, 1, 0, 1])):
        spans = [x for x in s.scan("see " + text + "here")[7] if x["label"] == "mit"]
        assert [(x["first_word"], x["last_word"]) for x in spans] == [(1 + 5 * i, 5 + 5 * i) for i in range(len(edits))]
        assert [x["edits"] for x in spans] == edits


def test_each_notice_gives_its_own_label_only():
    s = license_scan.Scanner(phrases={})
    for n in license_scan.NOTICES:
        assert s.scan(f"Some words. {n.text.title()}; other words.")[5] == n.label, n
        for i in range(0, len(n.text), 3):                     # an edit anywhere gives no other label
            assert s.scan(n.text[:i] + "q" + n.text[i + 1:])[5] in (n.label, "")
    assert s.scan("licensed under CC BY 4.0")[5] == "" and s.scan("licensd under cc by-nd 4.0")[5] == "cc-by-nd"


def test_license_scan_equals_a_search_of_the_whole_text():
    """Labels against a search of every notice over the whole text, without seeds or windows."""
    r = random.Random(9)
    s = license_scan.Scanner(phrases={})
    for _ in range(60):
        words = []
        for _ in range(r.randrange(1, 6)):
            n = r.choice(license_scan.NOTICES)
            t = list(n.text)
            for _ in range(r.randrange(0, n.edits + 2)):
                i = r.randrange(len(t))
                t[i:i + 1] = r.choice([[], ["x"], [t[i], "x"]])
            words += ["lorem ipsum"] * 3 + ["".join(t)]
        text = license_scan.normal(" ".join(words))
        whole = set()
        for i, n in enumerate(license_scan.NOTICES):
            h = s.search(text, i, 0, len(text))
            if h:
                whole.add(n.label)
        spans = s.fuzzy(text)
        assert {s.notices[h[2]].label for h in spans} <= whole
        assert bool(spans) == bool(whole)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_license_scan_grows_with_the_text_only():
    text = "all rights reserved " * 30_000
    s = license_scan.Scanner()
    began = time.process_time()
    out = s.scan(text)
    assert len(out[7]) == 30_000 == out[1] and time.process_time() - began < 10


def test_main_text():
    page = ('<html><head><title>T</title></head><body><nav><ul><li><a href="/a">menu</a></ul></nav><div class="ad">buy</div>'
            '<article><h1>Head</h1><p><b>One&amp;two<br>more \n x<p>Next <i>it</i>em</p><div class="comments"><p>troll</p></div>'
            '<script>var t="</p>";</script><p>End&nbsp;here</p></article><footer>&copy; x')
    assert html_extract.main_text(page) == "Head\n\nOne&two more x\n\nNext item\n\nEnd here"
    assert html_extract.main_text(None) == "" == html_extract.main_text("<html><nav>x</nav></html>")
    bare = "<body><ul class=menu><li>a<li>b</ul><p>" + "text " * 30 + "</p><p>ok</p><aside>side</aside><footer>f</footer>"
    assert html_extract.main_text(bare) == ("text " * 30).strip() + "\n\nok"
    assert html_extract.main_text("plain words &lt;b&gt; only") == "plain words <b> only"
    assert html_extract.main_text("<p>cut off <a hre") == "cut off"


def test_regions_between_surge_and_dive():
    assert html_extract.regions([0, 5, 0, 0, 3, 0, 0, 0, 7, 0]) == [(1, 5), (8, 9)]
    assert html_extract.regions([]) == [] == html_extract.regions([0, 0])


def test_line_blocks_choose_the_text_of_bare_divs():
    long = "some words of the text " * 8
    menu = "".join(f'<div><a href="/{i}">Section number {i}</a></div>' for i in range(8))
    page = (f'<body>{menu}<div>{long}one</div><div>short</div><div><a href="/x">see also</a></div><div>{long}two</div>'
            f'<div class="ad">a</div><div class="ad">b</div><div class="ad">c</div><div>{long}three</div>{menu}'
            '<div>Printed on paper</div>')
    assert html_extract.main_text(page).split("\n\n") == [long + "one", "short", "see also", long + "two", long + "three"]
    assert html_extract.main_text('<div><a href="/x">only a link</a></div>') == "only a link"
    assert html_extract.main_text(f'<h1><a href="/x">Title</a></h1><div>{long}</div>') == "Title\n\n" + long.strip()
    assert html_extract.main_text(f"<main><div>{long}</div>{menu}<div>end</main>").endswith("Section number 7\n\nend")
    assert html_extract.regions([4, 0, 0, 0, 9, 4, 0, 0, 0, 4], level=5) == [(4, 6)]


def test_every_page_goes_through_the_regions(monkeypatch):
    seen, real = [], html_extract.regions
    monkeypatch.setattr(html_extract, "regions", lambda *a: seen.append(a) or real(*a))
    for page in ("<article><p>marked</article>", "<p>bare", '<main><a href="/x">link</a></main>'):
        html_extract.main_text(page)
    assert len(seen) == 3


def test_marks_are_weighed_by_the_text_below_them():
    long = "some words of the text " * 8
    for name in ("social-history", "ad-hoc-networks", "related-work", "notice-period"):
        page = f'<article><p>{long}a</p><section id="{name}"><h2>On it</h2><p>{long}b</p><nav>x</nav></section><p>end</p></article>'
        assert html_extract.main_text(page).split("\n\n") == [long + "a", "On it", long + "b", "end"], name
    for inner in ("".join(f'<a href="/{i}">Share it there {i}</a>' for i in range(5)), "<p>Share</p><p>Like</p>"):
        assert html_extract.main_text(f'<article><p>{long}a</p><div class="share-buttons">{inner}</div></article>') == long + "a"
    for name in ("ad", "comments", "comment-list", "share", "social ad", "newsletter-signup"):
        assert html_extract.main_text(f'<article><p>{long}a</p><div class="{name}"><p>{long}</p></div></article>') == long + "a"


def test_marks_of_teasers_do_not_hide_the_text():
    long = "some words of the text " * 8
    page = f'<div><p>{long}a</p><p>{long}b</p></div><article>One teaser</article><article>Other teaser</article>'
    assert html_extract.main_text(page).startswith(f"{long}a\n\n{long}b")
    page = f'<p>Short line before</p><article><p>{long}a</p><p>end</p></article><p>Short line after</p>'
    assert html_extract.main_text(page) == f"{long}a\n\nend"


def test_deep_and_unclosed_markup_takes_linear_time():
    began = time.process_time()
    for page in ("<b>x" * 100_000, "<div>x" * 50_000 + "</span>" * 50_000, "<p><i>x" * 50_000):
        assert html_extract.main_text(page).count("x") == page.count("x")
    assert time.process_time() - began < 20


def test_main_text_after_unseen_elements_without_end_tags():
    article = "<article><p>Whole text</p></article>"
    assert html_extract.main_text(f"<html><head><meta charset=utf-8><title>T</title><body>{article}") == "Whole text"
    assert html_extract.main_text(f"<head><noscript><link rel=x><body>{article}") == "Whole text"
    for name in sorted(html_extract.UNSEEN):
        assert html_extract.main_text(f"<nav><ul><li><{name} id=x>menu</ul></nav>{article}") == "Whole text"
        assert html_extract.main_text(f"<body><{name}>x{article}") == "Whole text"
        page = f"<article><p>One <{name}><i>not</i> seen</{name}> two</p><p>Next</article>"
        assert html_extract.main_text(page) == "One two\n\nNext"


def test_gradient_of_the_attention_model():
    r = np.random.default_rng(0)
    bags = [r.normal(size=(n, quality_classifier.N_FEATURES)) for n in (1, 3, 2)]
    y = np.array([0, 1, 1])
    m = quality_classifier.fit(bags, y, hidden=3, gate=2, steps=2)
    m.p = {k: np.array(v, np.float64) for k, v in m.p.items()}
    x, starts = (np.concatenate(bags) - m.mean) / m.scale, np.array([0, 1, 4])
    weight = np.array([0.5, 0.25, 0.25])

    def loss():
        p = m.forward(x, starts)["y"]
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum()

    grad = m.gradient(m.forward(x, starts), y, weight)
    for k, v in m.p.items():
        flat = v.reshape(-1)
        for i in range(min(4, flat.size)):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert grad[k].reshape(-1)[i] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_passages_cover_whole_texts():
    assert quality_classifier.passages(None).shape == (1, quality_classifier.N_FEATURES)
    assert len(quality_classifier.passages("x" * 5000)) == -(-5000 // quality_classifier.PASSAGE)
    assert zlib.crc32(b"12") % 5 in range(5)
