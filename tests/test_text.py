import random
import re
import time
import unicodedata
import urllib.parse

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catlink.functions import markup, similarity, text as X, titlecase, urls, wikitext


def py_unaccent(s):
    out = []
    for ch in s:
        if ch in X.LIGATURES:
            out.append(X.LIGATURES[ch])
            continue
        m = re.match("(LATIN [A-Z]+ LETTER [A-Z]+) WITH", unicodedata.name(ch, ""))
        out.append(unicodedata.lookup(m.group(1)) if m else ch)
    return "".join(out)


def py_mangle(s):
    return re.sub(r"\W", "", re.sub(r"\(feat\. [^)]+\)$", "", py_unaccent(s.lower())))


NAMES = ["Prince", "Prince (2)", "P (10) x", "", None, "Sigur Rós", "Mø", "Æther", "AC/DC", "Ǽ ø đ ł ß", "日本 (feat. X)", "Foo (feat. Bar)", "áb", "x_²½", "line\nbreak (3)"]


def test_strip_suffix(column):
    assert column(X.strip_suffix, NAMES) == ["Prince", "Prince", "P (10) x", None, None, *NAMES[5:14], "line\nbreak"]


def test_mangle_name_equals_plain_python(column):
    values = [n for n in NAMES if n is not None]
    assert column(X.mangle_name, values) == [py_mangle(v) for v in values]


def test_catno_and_barcodes(column):
    assert column(X.catno_key, ["ABC 001", "abc001", None]) == ["abc001", "abc001", None]
    raw = ["0 12345-67890.5", "No Barcode", "none at all", "LC 1234", "123456789012", "1/2>3", ""]
    assert column(X.barcode_clean, raw) == ["012345678905", "none", "none", "LC 1234", "123456789012", "123", ""]
    assert column(X.is_barcode, ["123456789012", "1234567890123", "12345678901", "12345678901\n2"]) == [True, True, False, False]


def test_years_and_dates(spark, column):
    assert column(X.release_year, ["1999", "1999-00-00", "?", "", None, "99"]) == [1999, 1999, None, None, None, None]
    rows = [(1999, 1, 2), (1999, 1, None), (1999, None, 2), (None, None, None), (None, 3, None)]
    df = spark.createDataFrame(rows, "y int, m int, d int").select(X.partial_date("y", "m", "d"))
    assert [r[0] for r in df.collect()] == ["1999-01-02", "1999-01", "1999", "", "-03"]


@pytest.mark.parametrize("s", ["AC/DC (2) ~*é", "a+b", "ü & ñ", "日本", "", "x.y-z_1"])
def test_encode_name_equals_quote_plus(column, s):
    assert column(urls.encode_name, [s]) == [urllib.parse.quote_plus(s, "()").replace("%7E", "~")]


def test_decode_keeps_bad_escapes(column):
    values = ["a+b%C3%A9", "%zz+%", "100%", "%2", "plain"]
    assert column(urls.decode, values) == [urllib.parse.unquote_plus(v) for v in values]
    assert column(lambda c: urls.decode_name(c, "http://b/"), ["http://b/Artist+1+(2)"]) == ["Artist 1 (2)"]


def test_url_parts(column):
    assert column(lambda c: urls.id_from_url(c, "http://b.example/release/"), ["http://b.example/release/12-x", "http://bxexample/release/1", "http://b.example/release/x", None]) == [12, None, None, None]
    assert column(urls.store_id, ["http://s/album/id77?x", "none"]) == [77, None]
    assert column(urls.album_slug, ["/cd/foo/x", "/x"]) == ["foo", None]
    mbid = "0123456789abcdef-0123-0123-0123-0123"
    assert column(lambda c: urls.mbid(c, "artist"), [f"http://a/artist/{mbid}", f"http://a/artist/{mbid}/x"]) == [mbid, None]
    assert column(lambda c: urls.wiki_title(c, "fr"), ["http://fr.wikipedia.org/wiki/A%C3%A9+b", "http://en.wikipedia.org/wiki/A"]) == ["Aé+b", None]
    titles = ["AC/DC (band) é~*", "a b:c;d@e,f$g"]
    assert column(urls.quote_title, titles) == [urllib.parse.quote(t.replace(" ", "_"), "/$,:;@").replace("~", "%7E") for t in titles]
    assert column(urls.escape_query, ["A OR B+C ANDY NOT"]) == ["A or B\\+C ANDY not"]


def test_lists(column):
    lists = [["a"], ["a", "b"], ["a", "b", "c"], ["a", "b", "c", "d"], [], None]
    assert column(lambda c: X.quoted_list("album", c), lists, "array<string>") == [
        'album "a"', 'albums "a" and "b"', 'albums "a", "b" and "c"', 'albums "a", "b", "c" and 1 more', "", ""]
    assert column(lambda c: X.quoted_list("category", c), [["a", "b"]], "array<string>") == ['categories "a" and "b"']
    assert column(lambda c: X.quoted_list("", c), [["a"], ["a", "b"]], "array<string>") == ['"a"', '"a" and "b"']
    assert column(X.comma_and, [["a"], ["a", "b", "c"]], "array<string>") == ["a", "a, b and c"]


def test_array_concat(spark):
    df = spark.createDataFrame([(["a"], None), (None, ["b"]), (["a"], ["b"]), (None, None)], "x array<string>, y array<string>")
    assert [r[0] for r in df.select(X.array_concat("x", "y")).collect()] == [["a"], ["b"], ["a", "b"], None]


def test_scripts(column):
    words = ["カタ", "ひら", "漢字", "한글", "Latin", "漢 x"]
    assert column(lambda c: X.has_script(c, *X.LANGUAGE_SCRIPTS["ja"]), words) == [True, True, True, False, False, True]
    assert column(lambda c: X.in_script(c, "Han"), words) == [False, False, True, False, False, False]


def test_times_and_lines(column):
    assert column(X.duration_seconds, ["3:05", "x", "1:2"]) == [185, None, 62]
    assert column(X.format_seconds, [185, 0, None], "int") == ["3:05", "0:00", None]
    assert column(X.track_number, ["12. Foo", "Foo"]) == [12, None]
    assert column(X.format_iswc, ["T0123456789"]) == ["T-012.345.678-9"]


def test_title_case(column):
    cased = {"That's it": "That's It", "That's ain't it": "That's Ain't It", "That' it": "That' It", "the lord of the rings": "The Lord of the Rings", "(of)": "(of)", "a DJ by": "A DJ By"}
    assert column(titlecase.guess_case, list(cased)) == list(cased.values())
    titles = {"That' it (RADIO EDIT)": "That' It (radio edit)", "That' it (feat. DMX)": "That' It (feat. DMX)", "x (Album VERSION)": "X (album version)"}
    assert column(titlecase.guess_case_title, list(titles)) == list(titles.values())


def test_sort_names(spark):
    given = spark.createDataFrame([("juliet",)], "name string")
    names = spark.createDataFrame([("The XX",), ("Juliet Wallin",), ("A Band",), ("the xxx",), ("Foo Bar Baz",), ("Juliet",)], "name string")
    got = {r["name"]: r["sort_name"] for r in titlecase.add_sort_name(names, given).collect()}
    assert got == {"The XX": "XX, The", "Juliet Wallin": "Wallin, Juliet", "A Band": "Band, A", "the xxx": "Xxx, The", "Foo Bar Baz": "Foo Bar Baz", "Juliet": "Juliet"}


def py_ratio(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[j - 1]))
        row = new
    return 2 * row[-1] / (len(a) + len(b)) if a or b else 1.0


def test_similarity_against_brute_force(spark):
    rnd = random.Random(1)
    pairs = [("kitten", "sitting"), ("", "x"), ("", ""), ("same", "same")]
    pairs += [("".join(rnd.choice("abcd ") for _ in range(rnd.randint(0, 14))), "".join(rnd.choice("abcd ") for _ in range(rnd.randint(0, 14)))) for _ in range(60)]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", similarity.ratio("a", "b").alias("r"), similarity.ratio_at_least("a", "b", 0.8).alias("t"))
    for r in df.collect():
        want = py_ratio(r.a, r.b)
        assert r.r == pytest.approx(want)
        assert r.t == (pytest.approx(want) if want >= 0.8 else None)


def py_remove_markup(text):
    out, template, comment = [], 0, 0
    for token in re.split(r"(\{\{|\}\}|<!--|-->)", text):
        if token in ("{{", "}}"):
            template += 1 if token == "{{" else -1
        elif token in ("<!--", "-->"):
            comment += 1 if token == "<!--" else -1
        elif not template and not comment:
            out.append(token)
    return "".join(out)


def test_remove_markup(column):
    texts = ["a{{b {{c}} d}} e", "x }} y {{ z", "a<!-- b --> c", "open <!-- never", "{{{x}}}", "a-b<c - {d}", "plain", "", "--->", "<!---->x"]
    rnd = random.Random(2)
    texts += ["".join(rnd.choice(["{{", "}}", "<!--", "-->", "a", "{", "}", "-", "<", " "]) for _ in range(25)) for _ in range(80)]
    assert column(wikitext.remove_markup, texts) == [py_remove_markup(t) for t in texts]


PAGE = (
    "{{Infobox musical artist <!-- x -->\n| name = X {{y|z}} q\n| origin = [[Paris]], {{FRA}}\n| background=solo_singer\n|name = Z=1}} Intro {{a {{b}} c}} text.\n\nMore\n"
    "{{Persondata\n|NAME = Foo\n|DATE OF BIRTH=January 5, 1950\n}}[[Category:A b|key]][[Category:C]]"
)


def test_page_parts(column):
    assert column(lambda c: wikitext.infobox(c, "en"), [PAGE, "none", "{{Infobox person| a = 1\n|b"]) == [
        {"_type": "musical artist", "name": "Z=1", "background": "solo_singer", "origin": "[[Paris]], {{FRA}}"}, {}, {}]
    assert column(lambda c: wikitext.persondata(c, "en"), [PAGE, "none"]) == [{"name": "Foo", "date of birth": "January 5, 1950"}, {}]
    assert column(lambda c: wikitext.categories(c, "en"), [PAGE]) == [["A b", "C"]]
    assert column(wikitext.first_paragraph, [PAGE]) == ["Intro  text."]
    fr = "{{Métadonnées personne\n| NOM = Foo\n| DATE DE NAISSANCE = 1950\n| autre = x\n}}"
    assert column(lambda c: wikitext.persondata(c, "fr"), [fr]) == [{"name": "Foo", "date of birth": "1950", "autre": "x"}]


def test_long_pages_do_not_overflow(column):
    big = "{{Infobox person\n| a = " + "x" * 200000 + "\n| b = " + "{{t}} " * 3000 + "}} text " + "-<" * 300
    assert column(lambda c: F.length(wikitext.remove_markup(c)), [big]) == [6 + 600]
    assert column(lambda c: F.size(wikitext.infobox(c, "en")), [big]) == [3]


def test_markup_of_many_rows_and_long_pages(spark, column):
    rnd = random.Random(8)
    parts = ["{{", "}}", "<!--", "-->", "a", "é", "{", "}", "-", "<", ">", "!", " ", "漢"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(40))) for _ in range(500)] + [None]
    assert [None if x is None else x.decode() for x in markup.without_markup(pa.array(texts))] == [None if t is None else py_remove_markup(t) for t in texts]
    page = "{{a|" + "x {{b}} y" * 25_000 + "}} rest " + "w" * 800_000
    start = time.time()
    assert markup.without_markup(pa.array([page]))[0].decode() == " rest " + "w" * 800_000
    assert time.time() - start < 1


def test_nested_templates():
    head = re.compile(r"\{\{Infobox (person|musical artist)")
    text = ("{{Infobox person <!-- x -->\n| a = {{x|{{y|\nb = no}}|c=no}} z\n| b = 1\n| B = 2\n|c\n| {{d|e=f}}\n| g = h = i\r\n|k=}} {{Infobox person|a=late}}")
    assert markup.template(text, head) == ("person", {"a": "{{x|{{y|\nb = no}}|c=no}} z", "b": "2", "g": "h = i", "k": ""})
    assert markup.template("{{Infobox person|a=1 {{Infobox musical artist|b=2}} open", head) == ("musical artist", {"b": "2"})
    assert markup.template("{{Infobox person}}", head) == ("person", {}) and markup.template("{{Infobox person|a=1", head) is None and markup.template(None, head) is None
    start = time.time()
    assert len(markup.template("{{Infobox person\n" + "".join(f"| k{i} = {{{{v|{i}}}}}\n" for i in range(50_000)) + "}}", head)[1]) == 50_000
    assert markup.template("{{Infobox person" * 50_000, head) is None and time.time() - start < 3


def test_longest_common_subsequence_of_long_strings(spark):
    rnd = random.Random(9)
    pairs = [("".join(rnd.choice("abcdefgh") for _ in range(n)), "".join(rnd.choice("abcdefgh") for _ in range(m))) for n, m in ((63, 64), (64, 65), (128, 129), (200, 300), (1, 500), (0, 5))]
    df = spark.createDataFrame([*pairs, (None, "a"), ("a", None)], "a string, b string").select(similarity.lcs_length("a", "b").alias("n"))

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b, 1):
                new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
            row = new
        return row[-1]

    assert [r.n for r in df.collect()] == [*[plain(a, b) for a, b in pairs], None, None]
