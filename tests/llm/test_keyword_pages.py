from __future__ import annotations

import pytest

from tidemark.llm.keyword_pages import keyword_pages, keyword_share
from tidemark.llm.page_text import body_lines, decode

PROSE = "The ferry was late again, and nobody on the quay could say why it had to wait. We asked the keeper, who told us that the storm of last week had moved the buoys. After an hour the rain stopped and the crew came back with two of them."

SPAM = {
    "repeated": "buy lamp, " * 60,
    "rows": "\n".join(f"cheap lamp {w}" for w in "online sale best review top discount near new old heavy pale".split()),
    "mixed products": "Tags: lamp, heavy oven, pale canoe, ticket, drill, old saddle, bridge, kettle, late harbour, hotel, window",
    "bare strings": "lamp, heavy oven, pale canoe, ticket, drill, old saddle, bridge, kettle, late harbour, hotel, window, lamp, boiler",
    "places": " | ".join(f"plumber {p}" for p in "Aldo Bremo Celia Dorun Elvas Fermo Gilda Horna Ilvo Jorma".split()),
    "links": "\n".join(f"https://www.x{i}.example/lamp/{i}" for i in range(12)),
    "labelled links": "\n".join(f"[cheap lamp](http://shop{i}.example/lamp-{i})" for i in range(12)),
    "bbcode": " ".join(f"[url=http://s{i}.example/l]old lamp[/url]" for i in range(12)),
    "hash tags": "#lamp #cheap_lamp #lampsale #buylamp #oldlamp #lamp #canoe #ticket #drill",
    "disguised": " ".join(["L4mp l a m p  b u y   l a m p 0ld lamp ch34p lamp"] * 9),
    "one phrase": "Looking for a cheap lamp? Our cheap lamp is the cheap lamp you want when you want a cheap lamp. Get a cheap lamp today, because cheap lamp means cheap lamp. " * 4,
    "stuffed": " ".join(f"The crew had to wait for the cheap lamp near the {p}, cheap lamp. Nobody told us about the cheap lamp until the rain stopped (cheap lamp)." for p in "quay bridge gate mill harbour".split()),
}
WRITTEN = {
    "prose": PROSE,
    "described links": "\n".join(f"https://a{i}.example/page\nThis is where the keeper of the {w} writes about the storm and what it did to them." for i, w in enumerate(("mill", "quay", "gate", "inn"))),
    "ingredients": "\n".join(f"{i * 7 + 20} g {w}" for i, w in enumerate("flour butter sugar salt milk eggs yeast rye".split())),
    "timetable": "\n".join(f"{h:02d}:15  Station{chr(65 + h)}  2a" for h in range(5, 20)),
    "log": "\n".join(f"10:0{i}:11 WARN job{i}=fail" for i in range(9)),
    "names": "\n".join(f"{a} {b}, {c}" for a, b, c in zip("Anna Boris Clara Dora Emil Fritz".split(), "Alder Bach Conte Duval Ekman Faber".split(), "Aachen Brno Caen Delft Espoo Faro".split(), strict=True)),
    "prices": "\n".join(f"{w}: {i},50" for i, w in enumerate("Lamp Oven Canoe Drill Saddle Kettle".split())),
    "glossary": "\n".join(f"{w} – What the crew of the ferry calls the {w} when it is left on the quay." for w in "buoy cleat fender hawser thwart".split()),
    "verses": "\n".join(f"The {w} went down to the sea at night and was not seen again.\nAnd the rain, the rain came over the hill." for w in "keeper crew widow miller".split()),
    "references": "\n".join(f"[{i}] Author{i}, http://lib.example/{i}.html" for i in range(1, 12)),
    "error": "Something went wrong. Please try again later. (www.x.example)",
    "tags below prose": PROSE + "\nTags: lamp, oven, canoe",
}


@pytest.mark.parametrize("name", SPAM)
def test_spam(name):
    assert keyword_share(SPAM[name], None) > 0.5


@pytest.mark.parametrize("name", WRITTEN)
def test_written(name):
    assert keyword_share(WRITTEN[name], None) <= 0.5


def page(body, charset="utf-8"):
    return f"<html><head><title>x</title></head><body><nav><ul><li><a href='/1'>Home</a></li></ul></nav><div class=\"consent\">We use cookies.</div><p>{body}</p><footer>© 2020 x.example</footer></body></html>".encode(charset, "replace")


def test_markup_and_charsets():
    assert body_lines("Home\nWe use cookies.\nHi there", page("Hi there")) == ["Hi there"]
    german, russian = "Über die Brücke für alle, die müde wären und nicht schön schlafen.", "Тем вечером никто не мог сказать, что это за шум и почему он не стихал."
    polish = "Nikt już nie wie, że żółta łódź się rozpadła, choć gość ją widział."
    for text, charset in ((german, "utf-8"), (german, "cp1252"), (russian, "cp1251"), (russian, "koi8-r"), (polish, "iso-8859-2"), (polish, "cp1250")):
        assert decode(text.encode(charset)) == text
    spam = "дешёвая лампа, " * 40
    assert keyword_share("îøèáêà", page(spam, "cp1251")) > 0.9  # what counts is what the page says


def test_operator(spark):
    rows = [(1, SPAM["repeated"], None, 1.0), (2, PROSE, None, None), (3, None, page(SPAM["repeated"]), None), (4, "", None, None), (5, SPAM["repeated"], None, None), (6, SPAM["repeated"] * 3000, None, None)]
    docs = spark.createDataFrame([(i, t, r, s) for i, t, r, s in rows], "doc_id bigint, text string, raw binary, spam_share double")
    assert sorted(r.doc_id for r in keyword_pages(docs).collect()) == [1, 5, 6]  # copies of a case are cases, pages without text are none
    assert keyword_pages(docs.drop("raw")).count() == 3
    assert keyword_pages(docs.limit(0)).count() == 0


PHRASE = "Buy cheap running shoes online today with free fast delivery from trusted brands."
REPEATED = {
    "one sentence": (PHRASE + " ") * 30,
    "one line": "\n".join([PHRASE] * 30),
    "on end in prose": PROSE + " " + (PHRASE + " ") * 4,
    "places": " ".join(f"Buy cheap running shoes online in {c} with free fast delivery from trusted brands." for c in "Berlin Paris Rome Madrid Oslo Bern Vienna Prague Riga Kyiv".split()),
    "german": "Jetzt günstige Laufschuhe online kaufen mit schneller Lieferung für alle, die sparen wollen und nicht warten. " * 12,
    "russian": "Купите дешёвые беговые кроссовки с быстрой доставкой на дом и не ждите завтрашнего утра. " * 12,
    "separators": "lamp * heavy oven * pale canoe * ticket * drill * old saddle * bridge * kettle * late harbour * hotel * window * boiler",
    "numbered links": "\n".join(f"{i}. [cheap lamp](http://shop{i}.example/lamp-{i})" for i in range(1, 13)),
}
VERSES = "keeper crew widow miller baker tailor".split()
TOLD = {
    "chorus": "\n".join(f"The {w} went down to the sea at night and was not seen again.\nAnd the rain, the rain came over the hill to us." for w in VERSES),
    "chorus twice": "\n".join(f"The {w} went down to the sea at night and was not seen again by any of us.\nAnd the rain came over the hill.\nAnd the rain came over the hill." for w in VERSES),
    "measures": " ".join(f"The water at the gauge of the {p} bridge stood at {n} cm in the morning of the same day." for n, p in enumerate("upper lower old new stone iron".split(), 131)),
    "numbered references": "\n".join(f"{i}. {a} {t}, http://lib.example/{i}.html" for i, (a, t) in enumerate(zip("Alder Bach Conte Duval Ekman Faber Gorki".split(), "Tides Bells Mills Ferries Storms Bridges Lamps".split(), strict=True), 1)),
    "formulas": "\n".join(f"The sum of {a} and {b} is what we call {c} in the rest of the text." for a, b, c in zip("abcdef", "ghijkl", "mnopqr", strict=True)) + "\n" + PROSE * 3,
}


@pytest.mark.parametrize("name", REPEATED)
def test_repeated_sentences_separators_and_numbered_labels(name):
    assert keyword_share(REPEATED[name], None) > 0.5


@pytest.mark.parametrize("name", TOLD)
def test_refrains_measures_and_references_are_no_cases(name):
    assert keyword_share(TOLD[name], None) <= 0.5


def test_markup_is_found_wherever_it_begins():
    from tidemark.llm.page_text import body_lines

    page = "<html><body><nav><a href='/x'>Zebra quux</a></nav><p>Hi there</p></body></html>".encode()
    assert body_lines("", page) == body_lines("", b" " * 5000 + page) == ["Hi there"]
    assert body_lines("if a < b and c > d then", b"if a < b and c > d then") == ["if a < b and c > d then"]
