"""What a crawled page says: its own text without menu, cookie notice and footer, in the right charset."""

from __future__ import annotations

import html
import re
from collections import Counter

#: Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the a an of and to for was is in by with it on not had as from or who what before after one no nobody whoever that this there they she he its over when than be are at but if so up out my your our you i we any some will would could should",
    "de": "der die das und zu ein eine einer eines einen ist nicht mit von für hat wer jemand niemand es sich dem den im in auf aus was wie man als nie mehr wenn bis etwa über bevor obwohl wir sie am an ohne so auch nur noch uns",
    "fr": "le la les l de des du d un une et en qui que n pas pour au aux a est sans à plus ce cette quand avant bien pendant sur avec on s il elle celui ma son dans par ne se même nous vous",
    "es": "el los las un una de del que y en no por con para se su lo al es quien sin tan más antes durante aunque cuando mi fue ya muy según como aquel la le",
    "pl": "i w z na nie się do jest co ten ta to że od o jak przed przez choć ale czego kto który której bez nad po tego tej za moja pół nikt już czym ma nas a",
    "ru": "и в на не с о что как из за это от по у но так его для он она же тот кто который хотя почти а под после без перед нас моя до никто тем больше уже если мы вы такой",
}
LANGUAGE_OF = {w: lang for lang in reversed(list(FUNCTION_WORDS)) for w in FUNCTION_WORDS[lang].split()}
FUNCTION = frozenset(LANGUAGE_OF)

#: Charsets tried for bytes that are not UTF-8.
CHARSETS = ("cp1252", "cp1251", "koi8-r", "iso-8859-2", "cp1250")

#: Words with bytes beyond ASCII; all others read alike in every charset.
_FOREIGN = re.compile(rb"[A-Za-z]*[\x80-\xff][A-Za-z\x80-\xff]*")
#: What no language of these has: capitals inside words, signs in place of letters, two alphabets in one word.
_ODD = re.compile(r"(?<=[^\W\d_])[A-ZÀ-ÞА-ЯЁ](?=[a-zß-ÿа-яё])|[\x80-\x9f¤¦¬±¶\ufffd]|(?<=[a-z])[¹³¿]|(?<=[a-z])[А-яЁё]|(?<=[А-яЁё])[a-z]")
_WORD = re.compile(r"[^\W_]+")
#: Elements that are not the page's own text; their closing tag is looked for with str.find, so unclosed ones cost nothing.
_ASIDE = re.compile(r'(?i)<(nav|footer|script|style|header|aside)\b|<(div)\s+class="(?:consent|cookie)|<!(--)')
_BLOCK = re.compile(r"(?i)</?(?:p|div|li|ul|ol|h[1-6]|table|tr|td|br|section|article|blockquote|pre)\b[^<>]*>")
_LINK = re.compile(r'(?i)<a\b[^<>]*?href\s*=\s*["\']?([^"\'<>\s]*)[^<>]*>')
_TAG = re.compile(r"<[^<>]+>")
#: A tag that only pages with markup have, wherever it stands.
_MARKUP = re.compile(r"(?i)<(?:!doctype|html|head|body|title|meta|div|p|nav|footer|main|article|section|table|tr|td|ul|ol|li|h[1-6]|br|span|a)(?=[\s>/])")

#: Words of menus, cookie notices and footers, used only for pages without markup.
MENU_WORDS = frozenset(
    "about aide aktualności anmelden archiv archive archives archivo archiwum ayuda acceso accueil actualités blog boutique cennik connexion contact contacto emplois empleo forum foro help hilfe home impressum imprint inicio jobs "
    "kontakt laden login logowanie nas neues news noticias nosotros o pomoc praca precios preise press prices propos search shop sklep start startseite stellen tarifs tienda uns us über à архив вакансии вход главная контакты "
    "магазин нас новости о помощь форум цены".split()
)
_NOTICE = re.compile(r"(?i)\bcookies?\b|©|\(c\) \d{4}|privacy matters|files on your device|auf ihrem gerät|en su equipo|traceurs|rights reserved|rechte vorbehalten|droits réservés|derechos reservados|prawa zastrzeżone|права защищены|page last changed")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def function_share(words: list[str]) -> float:
    return sum(w in FUNCTION for w in words) / len(words) if words else 0.0


def decode(raw: bytes) -> str:
    """The bytes as UTF-8 if they are that, else in the charset that yields most function words and fewest odd letters.

    A page cut in the middle of a character counts as UTF-8 if all but its end is.
    """
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError as error:
        if error.start >= len(raw) - 4 and error.start > 8:
            return raw.decode("utf-8", "ignore")
    tokens = Counter(_FOREIGN.findall(raw))
    best, best_score = CHARSETS[0], None
    for charset in CHARSETS:
        score = 0
        for token, n in tokens.items():
            text = token.decode(charset, "replace")
            score += n * (sum(w in FUNCTION for w in words_of(text)) - len(_ODD.findall(text)))
        if best_score is None or score > best_score:
            best, best_score = charset, score
    return raw.decode(best, "replace")


def _own_part(source: str) -> str:
    lower, kept, at, absent = source.lower(), [], 0, set()
    for opening in _ASIDE.finditer(source):
        tag = (opening[1] or opening[2] or opening[3]).lower()
        if opening.start() < at or tag in absent:
            continue
        end = lower.find("-->" if tag == "--" else f"</{tag}", opening.end())
        if end < 0:
            absent.add(tag)
            continue
        kept.append(source[at : opening.start()])
        close = source.find(">", end)
        at = close + 1 if close >= 0 else len(source)
    return "\n".join([*kept, source[at:]])


def body_lines(text: str | None, raw: bytes | None) -> list[str]:
    """Lines of the page's own text. Markup tells menu, notice and footer apart where there is some; else known words do.

    Links keep their address: ``label`` and address stand on one line as ``address label``. NULL and empty pages give no lines.
    """
    if raw:
        source = decode(bytes(raw))
        if _MARKUP.search(source):
            start = source.lower().find("<body")
            source = _LINK.sub(r" \1 ", _own_part(source[max(start, 0) :]))
            source = html.unescape(_TAG.sub(" ", _BLOCK.sub("\n", source)))
            return [x for line in source.split("\n") if (x := line.strip())]
    lines = [x for line in (text or "").split("\n") if (x := line.strip())]
    return [x for x in lines if not _NOTICE.search(x) and not all(w in MENU_WORDS for w in words_of(x))]
