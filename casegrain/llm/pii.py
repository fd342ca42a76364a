"""Personal information inside free text (problem 7).

Method: a semi-Markov conditional random field. Candidate segments (names, e-mail addresses, phone numbers, identity
numbers, street addresses) are proposed liberally, several boundaries for each place; features of the whole span, its shape
and its surroundings give each a score relative to "outside". A dynamic program over the bounded-length segments, with
transition scores between neighbours, jointly chooses boundaries and types. Text between candidates can only be outside, so
leaving it out of the lattice is exact. Weights are trained by maximum likelihood on the corpus of ``pii_training`` and kept
in ``pii_weights.json``.
"""

from __future__ import annotations

import json
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrain.session import spread

KINDS = ("name", "email", "phone", "id_number", "address")
NEAR = 3  # characters between segments that count as neighbours
WEIGHTS = Path(__file__).with_name("pii_weights.json")

def _capitals() -> str:
    """All capital letters of the basic plane as ranges of a character class."""
    out, start = [], None
    for cp in range(0xFFFF):
        up = unicodedata.category(chr(cp)) in ("Lu", "Lt")
        if up and start is None:
            start = cp
        elif not up and start is not None:
            out.append(f"{chr(start)}-{chr(cp - 1)}")
            start = None
    return "".join(out)


UPPER = _capitals()
WORD = rf"(?:[{UPPER}]['’][{UPPER}][^\W\d_]+|[{UPPER}][^\W\d_]+(?:['’][^\W\d_]+)?)"
PART = rf"(?:{WORD}(?:-{WORD})?|[{UPPER}]\.(?:-?[{UPPER}]\.)?)"
PARTICLE = r"(?:(?:von|van|der|den|de|del|della|di|da|dos|du|la|le|el|al|bin|ibn|zu|zur|ter|ten)\s)"
NAMES = re.compile(rf"(?<![^\W_]){PART}(?:(?:, | ){PARTICLE}{{0,2}}{PART})*(?![^\W_])")
PIECE = re.compile(PART)
PARTICLE_WORDS = frozenset(PARTICLE[6:-4].split("|"))
EDGES = ".:,;([{\"'“«"
LED_BY = re.compile(rf"(?<![^\W_]){PARTICLE}{{1,2}}\Z")
PARTICLES = re.compile(rf"\b{PARTICLE}")
# Family names that most Chinese names begin with.
HAN_FAMILY = "王李张刘陈杨黄赵吴周徐孙马朱胡郭何高林罗郑梁谢宋唐许韩冯邓曹彭曾肖田董袁潘于蒋蔡余杜叶程苏魏吕丁任沈姚卢姜崔钟谭陆汪范金石廖贾夏韦付方白邹孟熊秦邱江尹薛"
HAN = re.compile(rf"[{HAN_FAMILY}](?=[\u4e00-\u9fff])")

DOT = r"(?:\.|\s?[\[({]\s?(?:dot|punkt|punto|point|\.)\s?[\])}]\s?| (?:dot|punkt|punto|point) )"
AT = re.compile(
    r"[\[({<]\s?(?:at|a|arroba|arobase|@)\s?[\])}>]\s?|@\s?|(?<=\w) (?:at|arroba|arobase) (?=[\w-]+(?: (?:dot|punkt|punto|point) |\s?[\[({]\s?(?:dot|punkt|punto|point)))", re.I
)
LOCAL = re.compile(rf"[\w+-]+(?:{DOT}[\w+-]+)*$", re.I)
LONGEST_LOCAL = 80  # a mail address has at most 64 characters before its sign
HOST = re.compile(rf"[\w-]+(?:{DOT}[\w-]+)*", re.I)
DOTS = re.compile(DOT, re.I)
TOP = re.compile(r"[\W_][^\W\d_]{2,}\Z")  # the last label of a host is a word

NUMBERS = re.compile(r"(?<![\w])(?:[A-Z]{1,4}[-. ]?)?[+(]{0,2}[A-Z]{0,3}\d[\dA-Z]*(?:\)?[ ./()\-–]{0,3}(?:[A-Z]{0,3}|[A-Z] )\d[\dA-Z]*)*(?:[ -][A-Z])?(?![\w])")
CHUNK = re.compile(r"[A-Z]*[+(]*[A-Z]*\d[\dA-Z]*|[A-Z]+")
LEAST_DIGITS, MOST_DIGITS = 5, 16

# Words that mark streets and flats.
STREET_WORDS = (
    "street st road rd lane ln avenue ave drive dr court ct close boulevard blvd way place pl square sq terrace crescent "
    "grove gardens hill row walk mews park parade quay rise view alley bridge circle highway hwy loop path trail"
).split()
STREET = rf"(?:{'|'.join(w.title() for w in STREET_WORDS)}|{'|'.join(w.upper() for w in STREET_WORDS)})\b\.?"
GERMAN = rf"(?:[{UPPER}][^\W\d_]*(?:(?i:stra(?:ß|ss)e|gasse|weg|platz|allee|ring|damm|ufer)|str\.)|(?i:Am|An der|Im|Zum|Zur|Auf dem) [{UPPER}][^\W\d_]+|(?:[{UPPER}][^\W\d_]+[ -]){{1,2}}(?i:Stra(?:ß|ss)e|Gasse|Weg|Platz|Allee|Ring))"
ROMANCE = rf"(?i:rue|avenue|boulevard|place|quai|chemin|allée|impasse|calle|avenida|avda\.|plaza|paseo|camino|ronda|C/|via|viale|piazza|rua|travessa)(?: (?:(?i:de|du|des|del|della|di|da|do|dos|das|la|las|les|los|el|le|l['’])\b ?)*(?:[{UPPER}][\w'’-]+)){{1,3}}"
FLAT = r"(?i:Flat|Apt\.?|Apartment|Unit|Suite|Room|Floor)\s?#?\s?\d+[A-Z]?"
HOUSE = r"\d{1,5}(?:\s?[A-Za-z]\b(?!-\d{5}))?(?:[-/]\d{1,4}(?!\d))?"
ENGLISH = rf"(?:{FLAT}, ?)?{HOUSE},? (?:[{UPPER}][\w'’-]+ ){{1,3}}{STREET}"
ADDRESSES = re.compile(
    rf"(?<![\w])(?=[{UPPER}\drabpqcivtzn])(?:{ENGLISH}|(?:{HOUSE},? (?:(?i:bis|ter) )?)?{ROMANCE}(?:,? (?:[nN]\.?º ?)?{HOUSE}(?![\w]))?|{GERMAN} {HOUSE}(?![\w]))"
)
TAIL = re.compile(
    rf",?\s?(?:{FLAT}(?![\w])|[A-Z]{{1,2}}\d{{1,2}}[A-Z]? ?\d[A-Z]{{2}}\b|[A-Z]{{2}} \d{{5}}(?:-\d{{4}})?\b|(?:[A-Z]{{1,2}}-)?\d{{4,5}}\b(?: ?[A-Z]{{2}}\b)?|[{UPPER}][^\W\d_]+(?!\w)(?:(?:[ -]|-(?:[a-z]{{1,5}}-){{1,2}})[{UPPER}'’][^\W\d_]+(?!\w)){{0,3}})"
)
TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)?|[^\s\w]|_")

# Given names in several languages; a capitalised word of this list may be a name by itself.
GIVEN = frozenset(
    "james john robert michael william david richard joseph thomas charles daniel matthew anthony mark paul steven andrew kevin brian george edward peter simon martin henry oliver jack "
    "mary patricia jennifer linda elizabeth barbara susan jessica sarah karen nancy lisa betty margaret sandra ashley emily donna carol ruth sharon helen laura emma alice grace lucy sophie hannah "
    "ana maria carmen josefa isabel dolores lucia pilar elena rosa juan jose luis carlos jorge pedro pablo manuel javier miguel diego alejandro fernando "
    "hans klaus jürgen wolfgang stefan andreas uwe heinz petra sabine monika renate ursula ingrid heike birgit anna katharina lukas felix "
    "jean pierre michel philippe alain nicolas julien françois marie nathalie isabelle sylvie catherine céline claire camille margaux "
    "giovanni marco luca paolo giulia chiara francesca ivan dmitri sergei olga natalia svetlana tatiana katarzyna piotr agnieszka pavel jana marek "
    "mohammed ahmed ali fatima aisha omar hassan yusuf layla ravi priya anil sunita rajesh deepa arjun lakshmi wei ming mei hiroshi yuki kenji sakura min-jun kofi amara chidi thandi".split()
)

# Cue words in the languages of the corpus, by what they announce.
CUES = {
    "title": "mr mrs ms miss mx dr doctor prof professor sir dame frau herr madame monsieur mme m sr sra señor señora don doña nurse sister rev",
    "phone": "phone tel telephone mobile cell call fax telefon tél téléphone teléfono telefono móvil mobil rufnummer durchwahl ring",
    "mail": "mail email courriel correo write wrote mailto",
    "id": "ssn mrn nhs passport social security insurance insured policy tax taxpayer medicare hospital record patient id identity chart file licence enrolment member membership "
    "versichertennummer sozialversicherungsnummer krankenkasse reisepass steuernummer dossier historia seguro pasaporte passeport sécurité nif dni nie steuer pid",
    "lab": "lot batch catalogue catalog cat protocol specimen doi trial record-no reagent order grant version ratio dose serial sample kit isbn ref fig table panel day charge los protokoll studie lote protocole essai",
    "live": "lives lived living address home house flat moved residing resident resides wohnt wohnhaft anschrift adresse habite demeurant reside domicilio residence located returned mailed send posted at",
    "person": "name patient signed thank thanks contact by kin daughter son mother father wife husband brother sister spouse courtesy correspondence korrespondenz correspondance correspondencia nom de from interpreter of to author written words discharge",
    "cite": "et al sign classification score scale criteria syndrome method stain grade described according reported figure criterion test staging",
    "place": "depot hospital clinic university regional general teaching royal medical health department faculty ward unit institute archived in city town laboratory centre center manufactured from company inc gmbh ltd",
}
CUE = {w: c for c, ws in reversed(CUES.items()) for w in ws.split()}


SHAPES = {cp: ("d" if chr(cp).isdigit() else "A" if chr(cp).isupper() else "a") for cp in range(0x250) if chr(cp).isalnum()}
DIGITS9 = str.maketrans("012345678", "999999999")
ZIP = re.compile(r"[A-Z]{1,2}[0-9]{1,2}[A-Z]? ?[0-9][A-Z]{2}$|[A-Z]{2} [0-9]{5}(?:-[0-9]{4})?$|[0-9]{4,5} [^,]+$")
FLAT_END = re.compile(FLAT + "$")
GOES_ON = re.compile(rf",?\s?[{UPPER}0-9]")
NEXT_NAME = re.compile(rf",? ?[{UPPER}][^\W\d_]")
NAME_BEFORE = re.compile(rf"[{UPPER}][^\W\d_]+\.? $|[{UPPER}]\. $")
NUMBER_AFTER = re.compile(r"[ ./()–-]{1,3}[0-9]")
INITIAL_END = re.compile(rf"[{UPPER}]\.$")
KNOWN_CUES = frozenset(CUE)


def _name_shape(s: str, pieces: list[str]) -> str:
    out = ["I" if p.endswith(".") else "U" if p.isupper() and len(p) > 2 else "H" if "-" in p else "C" for p in pieces]
    return ("," if ", " in s else "") + "".join(out) + ("p" if PARTICLES.search(s) else "")


def _emails(text: str, found: set[tuple[int, int, str]]) -> None:
    for m in AT.finditer(text):
        to = m.start() - (m.group()[0] != " " and text[max(0, m.start() - 1) : m.start()].isspace())
        base = max(0, to - LONGEST_LOCAL)
        local, host = LOCAL.search(text[base:to]), HOST.match(text, m.end())
        if not local or not host or (m.end() - to > 1 and m.group().strip() == "@" and not DOTS.search(host.group())):
            continue
        begins = {base + local.start(), base + local.start() + max([x.end() for x in DOTS.finditer(local.group()) if " " in x.group()] or [0])}
        ends = {host.end(), *(m.end() + x.start() for x in list(DOTS.finditer(host.group()))[1:] if " " in x.group() or x.group() == ".")}
        found.update((b, e, "email") for b in begins for e in ends if TOP.search(text, max(m.end() - 1, e - 24), e))


def _addresses(text: str, found: set[tuple[int, int, str]]) -> None:
    for m in ADDRESSES.finditer(text):
        ends, end = [m.end()], m.end()
        if text[end - 1] == ".":  # of an abbreviation or of the sentence
            ends.append(end - 1)
        for _ in range(4):
            t = TAIL.match(text, end)
            if not t or t.end() == end:
                break
            words = [end + x.end() for x in re.finditer(r"[\w'’]+", text[end : t.end()])]
            ends += words[-3:]
            end = t.end()
        found.update((m.start(), e, "address") for e in ends)


def _numbers(text: str, found: set[tuple[int, int, str]]) -> None:
    for m in NUMBERS.finditer(text):
        run = m.group()
        if len(run) < LEAST_DIGITS:
            continue
        parts = [(*c.span(), len(g) if (g := c.group()).isdigit() else sum(map(str.isdigit, g))) for c in CHUNK.finditer(run)]
        if sum(p[2] for p in parts) < LEAST_DIGITS:
            continue
        plain, base = "(" not in run and ")" not in run, m.start()
        for i, (s, _, _) in enumerate(parts):
            digits = 0
            for _, e, n in parts[i:]:
                digits += n
                if digits > MOST_DIGITS:
                    break
                if digits < LEAST_DIGITS:
                    continue
                b = s
                if not plain:
                    more = run.count("(", s, e) - run.count(")", s, e)
                    b += more == 1 and run[s] == "("  # a bracket around the whole is not part of it
                    if more - (b - s):
                        continue
                found.add((base + b, base + e, "id_number"))
                if digits >= 7:
                    found.add((base + b, base + e, "phone"))


def _titled(text: str, at: int) -> bool:
    before = TOKEN.findall(text[max(0, at - 24) : at])
    return bool(before) and CUE.get(before[-2 if before[-1] == "." and len(before) > 1 else -1].casefold()) == "title"


def _names(text: str, found: set[tuple[int, int, str]]) -> None:
    for m in NAMES.finditer(text):
        run, base = m.group(), m.start()
        if " " not in run:
            before = text[max(0, base - 24) : base].split()
            led = LED_BY.search(text, max(0, base - 12), base) if before and before[-1] in PARTICLE_WORDS else None
            if run.casefold() not in GIVEN:
                if led:
                    before = text[max(0, led.start() - 24) : led.start()].split()
                if not before or CUE.get(before[-1].strip(EDGES).casefold()) not in ("title", "person"):
                    continue
            found.add((base, m.end(), "name"))
            if led:
                found.add((led.start(), m.end(), "name"))
            continue
        parts = [(*p.span(), p.group()) for p in PIECE.finditer(run)]
        low = [p[2].casefold().rstrip(".") for p in parts]
        if base and (w := text[max(0, base - 8) : base].split()) and w[-1] in PARTICLE_WORDS and (p := LED_BY.search(text, max(0, base - 12), base)) and _titled(text, p.start()):
            found.update((p.start(), base + e, "name") for _, e, last in parts[:3] if not last.endswith("."))
        for i, (s, _, first) in enumerate(parts):
            cue, given = CUE.get(low[i - 1]) if i else None, low[i] in GIVEN
            alone = not i or given or cue in ("title", "person")
            if cue == "title" and s - parts[i - 1][1] > 2:  # with the particle that stands before
                found.update((base + parts[i - 1][1] + 1, base + e, "name") for _, e, last in parts[i : i + 3] if not last.endswith("."))
            for _, e, last in parts[i + (not alone) : i + 5]:
                if not last.endswith(".") or INITIAL_END.search(last):
                    if i == 0 and not given and e - s == len(first):
                        continue
                    found.add((base + s, base + e, "name"))
    if not text.isascii():
        for m in HAN.finditer(text):
            for n in (2, 3):
                if text[m.start() + 1 : m.start() + n].isalpha():
                    found.add((m.start(), m.start() + n, "name"))


# What a text must hold for a proposal of each sort; expressions that the engine of Arrow can search in whole batches.
_DOT = r"(?:\.|\s?[\[({]\s?(?:dot|punkt|punto|point|\.)\s?[\])}]\s?| (?:dot|punkt|punto|point) )"
_HOUSE = r"\p{Nd}(?:[\s\p{Z}]?[A-Za-z])?(?:[-/]\p{Nd}+)?"
_NAME = r"\p{Lu}[\pL\pN_'’-]+"
_ROAD = r"(?i:rue|avenue|boulevard|place|quai|chemin|allée|impasse|calle|avenida|avda\.|plaza|paseo|camino|ronda|C/|via|viale|piazza|rua|travessa)"
_ARTICLE = r"(?i:de|du|des|del|della|di|da|do|dos|das|la|las|les|los|el|le|l['’])"
_ENDING = r"(?:(?i:stra(?:ß|ss)e|gasse|weg|platz|allee|ring|damm|ufer)|str\.)"
SIGNS = {
    "email": rf"(?i)(?:@|[\[({{<]\s?(?:at|a|arroba|arobase|@)\s?[\])}}>]| (?:at|arroba|arobase) )\s?(?:[\pL\pN_-]+{_DOT})*[\pL\pN_-]*\pL\pL",
    "address": rf"{_HOUSE},? (?:{_NAME} ){{1,3}}(?:{'|'.join(w.title() for w in STREET_WORDS)}|{'|'.join(w.upper() for w in STREET_WORDS)})|{_ROAD} (?:{_ARTICLE} ?)*{_NAME}"
    rf"|\p{{Lu}}\pL*{_ENDING} \p{{Nd}}|(?i:Am|An der|Im|Zum|Zur|Auf dem) \p{{Lu}}\pL+ \p{{Nd}}|\p{{Lu}}\pL+[ -](?i:Stra(?:ß|ss)e|Gasse|Weg|Platz|Allee|Ring) \p{{Nd}}",
    "number": r"\p{Nd}(?:[A-Z ./()\-–]*\p{Nd}){4}",
}


def signs(texts: list[str]) -> list[tuple[bool, bool, bool]]:
    """For each text, whether it can hold an e-mail address, a street address, a number of enough digits."""
    a = pa.array(texts, pa.large_string())
    return list(zip(*(pc.match_substring_regex(a, p).to_pylist() for p in SIGNS.values()), strict=True))


def candidates(text: str, may: tuple[bool, bool, bool] = (True, True, True)) -> list[tuple[int, int, str]]:
    """Liberal proposals (start, end, kind), sorted; several boundaries for each place. ``may``: what ``signs`` says of the text."""
    found: set[tuple[int, int, str]] = set()
    if may[0]:
        _emails(text, found)
    if may[1]:
        _addresses(text, found)
    if may[2]:
        _numbers(text, found)
    _names(text, found)
    return sorted(found)


class Around:
    """Features of the places of one text, each place looked at once; equal surroundings share theirs through ``memo``."""

    def __init__(self, text: str, memo: dict[tuple, tuple] | None = None):
        self.text = text
        self.memo = {} if memo is None else memo
        self.lefts: dict[int, tuple[list[str], str, str, dict[str, float]]] = {}
        self.rights: dict[int, tuple[list[str], dict[str, float]]] = {}

    def left(self, start: int) -> tuple[list[str], str, str, dict[str, float]]:
        """Features of what stands before, the nearest cue, whether a sentence begins, and room for scores per kind."""
        got = self.lefts.get(start)
        if got is not None:
            return got
        text = self.text
        before = text[max(0, start - 2) : start]
        key = (*TOKEN.findall(text[max(0, start - 60) : start])[-4:], before, None)
        got = self.memo.get(key)
        if got is None:
            toks = [t.casefold() for t in key[:-2]]
            toks = ["^"] * (4 - len(toks)) + toks
            cues = [CUE.get(w, "") for w in toks]
            near = next((c for c in reversed(cues) if c), "")
            w = [t.translate(DIGITS9)[:6] if t[:1].isdigit() else t for t in toks]
            fs = [f"l1={w[3]}", f"l2={w[2]} {w[3]}", f"l0={w[2]}", f"near={near}", f"line={before[-1:] in ('', chr(10))}", *sorted({f"c={c}" for c in cues if c})]
            got = self.memo[key] = (fs, near, "sent" if before.strip() in ("", ".", "!", "?", ":") else "mid", {})
        self.lefts[start] = got
        return got

    def right(self, end: int) -> tuple[list[str], dict[str, float]]:
        """Features of what follows, and room for scores per kind."""
        got = self.rights.get(end)
        if got is not None:
            return got
        key = tuple(TOKEN.findall(self.text[end : end + 40])[:2])
        got = self.memo.get(key)
        if got is None:
            toks = [t.casefold() for t in key] + ["$"] * (2 - len(key))
            w = [t.translate(DIGITS9)[:6] if t[:1].isdigit() else t for t in toks]
            got = self.memo[key] = ([f"r1={w[0]}", f"r2={w[0]} {w[1]}", f"ra={CUE.get(toks[0], '') or CUE.get(toks[1], '')}"], {})
        self.rights[end] = got
        return got

    def number(self, start: int, end: int) -> tuple[str, str, str, str, bool]:
        """All that the features of a number depend on: its shape, how it begins, the nearest cue, what it continues and goes on with."""
        text = self.text
        one, two = text[max(0, start - 1) : start], text[max(0, start - 2) : max(0, start - 1)]
        joined = "code" if one in ("-", "/", ".", "–") and two.isalnum() else "number" if (one if one.strip() else two).isdigit() else ""
        s = text[start:end]
        c = s[0]
        head = c if c in "+(" else "00" if s.startswith("00") else "0" if c == "0" else "1-" if s.startswith("1-") else "A" if c.isalpha() else "d"
        return s.translate(SHAPES), head, self.left(start)[1], joined, NUMBER_AFTER.match(text, end, end + 4) is not None

    def whole(self, start: int, end: int, kind: str) -> list[str]:
        """Features of the whole span with its surroundings."""
        text, s = self.text, self.text[start:end]
        near = self.left(start)[1]
        if kind == "name":
            pieces = PIECE.findall(s) or [s]
            shape = _name_shape(s, pieces)
            low = [p.casefold().rstrip(".") for p in pieces]
            around = text[max(0, start - 16) : start] + text[end : end + 16]
            letters = sum(map(str.isalpha, around))
            out = ["b", f"s={shape}", f"s={shape}&near={near}", f"n={len(pieces)}", f"first={low[0]}", f"last={low[-1]}", f"f3={low[0][-3:]}", f"e3={low[-1][-3:]}"]
            out += [f"lex={CUE[w]}" for w in low if w in KNOWN_CUES]
            out += [f"caps={sum(p.isupper() and len(p) > 2 for p in pieces)}/{min(3, len(pieces))}", f"short={any(p.isupper() and 2 <= len(p) <= 4 for p in pieces)}"]
            out.append(f"around={letters > 0 and sum(map(str.isupper, around)) > 0.8 * letters}")
            out.append(f"given={''.join('y' if w in GIVEN else 'n' for w in low[:3])}")
            if any(w in STREET_SET for w in low):
                out.append("street")
            if NEXT_NAME.match(text, end, end + 4):
                out.append("more")
            if NAME_BEFORE.search(text[max(0, start - 20) : start]):
                out.append("part")
            out.append(self.left(start)[2])
            if pieces == [s] and ord(s[0]) >= 0x4E00:
                out.append(f"han={text[start - 1 : start]}|{text[end : end + 1]}")
            return out
        if kind in ("phone", "id_number"):
            return _number_features(*self.number(start, end))
        if kind == "address":
            tail = s.rsplit(",", 1)[-1].strip()
            words = " ".join(w if w.isdigit() or w.isupper() else "Aa" if w[:1].isupper() else w[:3] for w in tail.split()).translate(SHAPES)
            return ["b", f"t={words[:24]}", f"parts={s.count(',')}", f"zip={bool(ZIP.search(s))}", f"on={bool(GOES_ON.match(text, end, end + 3))}", f"flat={bool(FLAT_END.search(s))}", f"stop={text[end : end + 1]}", f"zip={bool(ZIP.search(s))}&on={bool(GOES_ON.match(text, end, end + 3))}"]
        dots = DOTS.findall(s)
        return ["b", f"at={'@' in s}", f"dots={min(5, len(dots))}", f"tail={len(DOTS.split(s)[-1])}", f"sp={' ' in s}", f"part={text[max(0, start - 1) : start] in '._+-' and start > 0}", f"more={bool(re.match(r'\.[^\W_]', text[end : end + 2]))}"]


STREET_SET = frozenset(STREET_WORDS)


def _number_features(shape: str, head: str, near: str, joined: str, goes_on: bool) -> list[str]:
    digits, letters = shape.count("d"), len(shape) - len(shape.lstrip("A"))
    out = ["b", f"s={shape}", f"d={digits}", f"h={head}", f"h={head}&d={digits}", f"s={shape}&near={near}", f"near={near}&h={head}", f"near={near}&d={digits}"]
    out += [f"k={digits == len(shape)}{len(set(shape) - set('dAa'))}", f"cut={joined}{goes_on}"]
    return [*out, f"p={letters}"] if letters else out


def features(text: str, start: int, end: int, kind: str, around: Around | None = None) -> list[str]:
    """All features of one candidate, each for its kind."""
    a = around or Around(text)
    return [f"{kind}|{f}" for f in (*a.left(start)[0], *a.right(end)[0], *a.whole(start, end, kind))]


def _gap(text: str, a: int, b: int) -> str:
    return text[a:b].replace(" ", "_")


class SegmentCRF:
    """Scores and decoding over candidate segments; features are joint, so their parts are added up once for each place."""

    def __init__(self, weights: dict[str, float] | None = None):
        self.w = {} if weights is None else weights
        self.by_kind: dict[str, dict[str, float]] | None = None
        self.numbers: dict[str, dict[tuple, float]] = {"phone": {}, "id_number": {}}
        self.memo: dict[tuple, tuple] = {}

    def _kinds(self) -> dict[str, dict[str, float]]:
        by: dict[str, dict[str, float]] = {k: {} for k in KINDS}
        base: dict[str, float] = {}
        gap: dict[str, float] = {}
        for f, v in self.w.items():
            if ">" in f[:20] and f.partition(">")[0] in by:
                pair, sep, _ = f.partition("|")
                (gap if sep else base)[pair] = max(v, (gap if sep else base).get(pair, 0.0))
        self.lift = 2 * max([0.0, *(base.get(p, 0.0) + max(0.0, gap.get(p, 0.0)) for p in base.keys() | gap.keys())])
        for f, v in self.w.items():
            kind, sep, rest = f.partition("|")
            if sep and kind in by:
                by[kind][rest] = v
        return by

    def score(self, fs: list[str]) -> float:
        get = self.w.get
        return sum(get(f, 0.0) for f in fs)

    def link(self, text: str, a: tuple[int, int, str], b: tuple[int, int, str]) -> list[str]:
        return [f"{a[2]}>{b[2]}", f"{a[2]}>{b[2]}|{_gap(text, a[1], b[0])}"]

    def scores(self, text: str, cs: list[tuple[int, int, str]]) -> list[float]:
        """The score of each candidate."""
        if self.by_kind is None:
            self.by_kind = self._kinds()
        if len(self.memo) > 200_000:
            self.memo.clear()
        around, out, at, number = Around(text, self.memo), [], None, ()
        for start, end, kind in cs:
            get = self.by_kind[kind].get
            fs, _, _, known = around.left(start)
            left = known.get(kind)
            if left is None:
                left = known[kind] = sum([get(f, 0.0) for f in fs])
            fs, known = around.right(end)
            right = known.get(kind)
            if right is None:
                right = known[kind] = sum([get(f, 0.0) for f in fs])
            if kind in ("phone", "id_number"):
                if at != (start, end):  # a phone number comes after the identity number of the same place
                    at, number = (start, end), around.number(start, end)
                numbers = self.numbers[kind]
                whole = numbers.get(number)
                if whole is None:
                    if len(numbers) > 200_000:
                        numbers.clear()
                    whole = numbers[number] = sum([get(f, 0.0) for f in _number_features(*number)])
            else:
                whole = sum([get(f, 0.0) for f in around.whole(start, end, kind)])
            out.append(left + right + whole)
        return out

    def decode_all(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        """``decode`` of many texts; null has no spots."""
        return [self.decode(t, may) if t else [] for t, may in zip(texts, signs(texts), strict=True)]

    def decode(self, text: str, may: tuple[bool, bool, bool] = (True, True, True)) -> list[tuple[int, int, str]]:
        """The best set of segments that do not overlap."""
        cs = candidates(text, may)
        if not cs:
            return []
        owns = self.scores(text, cs)
        # A candidate that its neighbours cannot lift above nothing is in no best set.
        kept = sorted((c[1], c[0], c[2], own) for c, own in zip(cs, owns, strict=True) if own + self.lift > 0)
        if not kept:
            return []
        cs, owns = [(s, e, k) for e, s, k, _ in kept], [own for *_, own in kept]
        ends: list[int] = []
        best: list[tuple[float, int]] = []  # best total of candidates up to here, and which ends it
        total: list[tuple[float, int]] = []
        for c, own in zip(cs, owns, strict=True):
            i = bisect_right(ends, c[0] - NEAR - 1)
            v, back = best[i - 1] if i else (0.0, -1)
            if v < 0:
                v, back = 0.0, -1
            while i < len(ends) and ends[i] <= c[0]:
                t = total[i][0] + self.score(self.link(text, cs[i], c))
                if t > v:
                    v, back = t, i
                i += 1
            total.append((own + v, back))
            k = len(ends)
            ends.append(c[1])
            top = best[-1] if best else (0.0, -1)
            best.append((own + v, k) if own + v > top[0] else top)
        out, k = [], best[-1][1]
        while k >= 0:
            out.append(cs[k])
            k = total[k][1]
        return out[::-1]


_model: list[SegmentCRF] = []


def model() -> SegmentCRF:
    if not _model:
        _model.append(SegmentCRF(json.loads(WEIGHTS.read_text())))
    return _model[0]


def redact(text: str, spots: list[tuple[int, int, str]]) -> str:
    """``text`` with typed placeholders; all else is unchanged."""
    out, at = [], 0
    for s, e, k in spots:
        out += (text[at:s], f"[{k.upper()}]")
        at = e
    return "".join([*out, text[at:]])


def find_personal(documents: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(doc_id, start_pos, end_pos, kind) of every spot in ``documents`` (doc_id, text); offsets count characters from 0.

    Null and empty texts have no spots. Texts are read whole, whatever their length; repeated rows repeat their spots.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        crf = SegmentCRF(weights) if weights else model()
        for b in batches:
            out = [(d, *x) for d, found in zip(b["doc_id"], crf.decode_all(b["text"].tolist()), strict=True) for x in found]
            yield pd.DataFrame(out, columns=["doc_id", "start_pos", "end_pos", "kind"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text") > 0)
    return spread(docs, "doc_id").mapInPandas(scan, "doc_id long, start_pos long, end_pos long, kind string")


def replace_personal(documents: DataFrame) -> DataFrame:
    """``documents`` with ``redacted`` and ``spots`` (how many were replaced); null stays null."""

    @F.pandas_udf("struct<redacted: string, spots: int>")
    def replaced(texts: pd.Series) -> pd.DataFrame:
        rows = []
        texts = [t if isinstance(t, str) else None for t in texts]
        for t, spots in zip(texts, model().decode_all(texts), strict=True):
            rows.append((redact(t, spots) if isinstance(t, str) else None, len(spots)))
        return pd.DataFrame(rows, columns=["redacted", "spots"])

    others = [c for c in documents.columns if c not in ("redacted", "spots")]
    return spread(documents.select(*others)).withColumn("__r", replaced("text")).select(*others, "__r.*")
