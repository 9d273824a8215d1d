"""Secret scans: fixed patterns, and novelty by zstandard primed with a dictionary.

The patterns (``assign``, ``access``, ``hex``) mark spans as they stand. Beside them, a string of key-like characters that
stands near a sensitive word is a candidate. It is compressed with a dictionary made of the text around it and of common
identifiers; the bytes that it adds, against what a random string of its alphabet takes at best, say whether it repeats what the code
around it says (a name, a path, prose) or is new. Candidates that stay incompressible are reported as ``novel``.

Null or empty texts have no spans. Each row stands alone: repeated rows give the same spans, an empty table gives no rows. Of other columns
only the key is read, so they may have any names; ``redact`` hands all on as they are. Very long texts are scanned whole, in time with their
length. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import bounded_batches, slices, text_of
from siltstone.llm.words import hold

KINDS = ("assign", "access", "hex", "novel")
#: Patterns of the contract. ASCII letters alone fold, so the flags stand inside.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a run that is too short holds no longer match, so the length can stand in the pattern
HEX = re.compile(r"[0-9a-f]{24,}")
#: Words near which a random string matters, and identifiers that are common in code and settings.
SENSITIVE = re.compile(r"(?ai)passw|secret|token|api.?key|credential|bearer|private.?key|auth")
IDENTIFIERS = (
    "password passwd secret token api_key apikey access_key secret_key private_key public_key client_id client_secret user username "
    "authorization bearer basic credentials credential config settings environment default example localhost production development "
    "https://www.example.com/ http://localhost:8080/ /usr/local/bin /home/user ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789 "
    "function return class import export const static public private string integer boolean null true false none undefined "
)
#: Common words: how their letters follow each other tells names and prose from random letters.
WORDS = (
    "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were her all she there would their we "
    "him been has when who will more no if out so said what up its about into than them can only other new some could time these two may then do first any my now such like our over man me even most made after also did many before must through back years where much your way well down should because each just those people how too little state good very make world still own see men work long get here between both life being under never day same another know while last might us great old year off come since against go came right used take three "
    "access account action address administrator analysis application argument array assembly async authentication authorization authority available backup balance binary branch browser buffer build bundle button cache callback certificate change channel character check child client cloud cluster code collection column command comment commit common communication company compiler component configuration connection constructor container content context control controller conversation cookie count counter create current customer data database date debug decoder default definition delete department dependency description destination development device dictionary digest directory document domain download driver element email enable encoder encryption endpoint engine entity enterprise entry environment error event exception execution export expression extension factory failure feature field file filter folder format framework frontend function gateway generator graph group handler hardware header history identifier image implementation import index information initialize input instance instruction integration interface internal international invalid issuer iterator java javascript keyboard language large layer layout length level library license listener loader local location logger login machine management manager mapping master memory merge message metadata method microservice migration model module monitor mutation namespace native network node notification number object operation operator option order organization output package page parameter parent parser partition password path pattern payment performance permission personal pipeline platform plugin pointer policy pool portal position prefix primary private process processor product production profile program project property protocol provider proxy public publish python query queue random reader record recovery redirect reference refresh region register registry release remote renderer replica report repository request required resource response result return role router runtime sample scheduler schema script search security select sender sequence serial server service servlet session setting shared signature simple single small software source stack standard static status storage store stream string structure style submit subscription support switch symbol synchronize system table target task template terminal test text thread timeout timestamp token tools tracking transaction transfer transform translation transport trigger type unit universal update upload user utility validation validator value variable vector vendor verification version video view virtual volume warning watch web widget window wrapper writer "
)
CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
NEAR, AROUND = 64, 512


def alphabet(s: str) -> str:
    """The characters that a random string like ``s`` is drawn from: hex digits, or the classes and the punctuation that it holds."""
    used = set(s)
    for hexed in ("0123456789abcdef", "0123456789ABCDEF"):
        if used <= set(hexed) and not s.isdigit():
            return hexed
    return "".join(c for c in CLASSES if used & set(c)) + "".join(sorted(used.difference(*CLASSES)))


def chains(words: str) -> tuple[Counter, Counter, Counter]:
    """How often each letter follows two, one and no characters in ``words``; a space stands for what is no letter."""
    letters = re.sub(r"[^a-z]+", " ", words.lower())
    return Counter(zip(letters, letters[1:], letters[2:])), Counter(zip(letters, letters[1:])), Counter(letters)


THREE, TWO, ONE = chains(f" {IDENTIFIERS} {WORDS} ")


def word_bits(s: str, letters: str) -> float:
    """Bits of ``s`` in a code over ``letters`` that expects words, changes of case as identifiers have them, and what ``s`` itself repeats.

    It is a code, so that a random string comes out shorter by k bits or more in one case of 2 ** k at most.
    """
    marks = sorted(set(letters.lower()))
    alphas, digits, others = ([x for x in marks if x.isalpha()], [x for x in marks if x.isdigit()], [x for x in marks if not x.isalnum()])
    cased = any(c.isupper() for c in letters) and any(c.islower() for c in letters)

    def shares(one: str, two: str) -> dict[str, float]:
        """The next character's chances after ``one``, ``two``."""
        a, b = (x if x.isalpha() else " " for x in (one, two))
        known = {x: THREE[a, b, x] + 3 * TWO[b, x] / ONE[b] for x in (*alphas, *(" " if digits or others else ""))}
        out = dict.fromkeys(marks, 0.1 / len(marks))
        if two.isdigit():
            for x in marks:
                out[x] += 0.9 * (0.6 / len(digits) if x.isdigit() else 0.4 / (len(marks) - len(digits))) if len(digits) < len(marks) else 0.9 / len(marks)
            return out
        whole = sum(known.values())
        if not whole:
            return dict.fromkeys(marks, 1 / len(marks))
        for x in alphas:
            out[x] += 0.9 * known[x] / whole
        rest = 0.9 * known.get(" ", 0.0) / whole
        for x in others:
            out[x] += rest * (0.8 if digits else 1.0) / len(others)
        for x in digits:
            out[x] += rest * (0.2 if others else 1.0) / len(digits)
        return out

    told: dict[tuple[str, str], dict[str, float]] = {}  # at most the square of the alphabet
    own, seen, bits, one, two, case = Counter(), Counter(), 0.0, " ", " ", ""
    for c in s:
        low = c.lower()
        if (one, two) not in told:
            told[one, two] = shares(one, two)
        plain = told[one, two][low]
        again = (own[two, low] + plain) / (seen[two] + 1)
        bits -= math.log2(0.8 * plain + 0.2 * again)
        own[two, low] += 1
        seen[two] += 1
        if cased and c.isalpha():
            up = {"": 0.4, "l": 0.12, "u": 0.5}[case]
            bits -= math.log2(up if c.isupper() else 1 - up)
        case = "u" if c.isupper() else "l" if c.islower() else ""
        one, two = two, low
    return bits


def marginal_bytes(candidate: str, around: str) -> int:
    """Compressed bytes that ``candidate`` adds when the compressor knows ``around`` and the identifiers."""
    primed = zstandard.ZstdCompressionDict((IDENTIFIERS + around).encode("utf-8", "replace"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    compress = zstandard.ZstdCompressor(level=3, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False).compress
    return len(compress(candidate.encode())) - len(compress(b""))


def novel(text: str, start: int, end: int, least_ratio: float) -> bool:
    """Whether neither words nor the dictionary make the string much shorter than a random one of its length and alphabet takes at best."""
    s = text[start:end].rstrip("=")
    letters = alphabet(s)
    best = min(len(s), len(s) * math.log2(len(letters)) / 8) if s else 0.0
    if not best or word_bits(s, letters) < 8 * least_ratio * best:
        return False
    around = text[max(0, start - AROUND) : start] + text[end : end + AROUND]
    return marginal_bytes(s, around) >= least_ratio * best


def scan(text: str, least_ratio: float = 0.85) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as in KINDS."""
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6] if ("=" in text or ":" in text) else []
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text)]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    taken = sorted((a, b) for _, a, b in spans)
    starts, ends = [a for a, _ in taken], [0, *accumulate((b for _, b in taken), max)]
    seen = -1
    for word in SENSITIVE.finditer(text):
        for m in CANDIDATE.finditer(text, max(seen, word.start() - NEAR, 0), min(len(text), word.end() + NEAR + 256)):
            start, end = m.span()
            if start > word.end() + NEAR:
                break
            if start and CANDIDATE.match(text[start - 1] * 16):  # the window cut the string's beginning off
                while start and re.match(r"[A-Za-z0-9+/_=-]", text[start - 1]):
                    start -= 1
            while end < len(text) and re.match(r"[A-Za-z0-9+/_=-]", text[end]):
                end += 1
            if end <= seen:
                continue
            seen = end
            if ends[bisect_left(starts, end)] <= start and novel(text, start, end, least_ratio):
                spans.append(("novel", start, end))
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0])))


def secret_spans(df: DataFrame, text: str = "text", key: str = "doc_id", least_ratio: float = 0.85) -> DataFrame:
    """``key`` and spans (array of kind, start, end) of every row's whole text."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold({})
        for part, texts in slices(batches, 1):
            found = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in scan(t, least_ratio)] for t in texts]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(span))], names=[key, "spans"])

    rows = df.select(F.col(f"`{key}`"), text_of(text).alias("__text"))
    return bounded_batches(rows).mapInArrow(scanned, f"`{key}` {rows.schema[0].dataType.simpleString()}, spans array<struct<kind: string, start: long, end: long>>")


def redact(df: DataFrame, text: str = "text", least_ratio: float = 0.85) -> DataFrame:
    """``df`` with every span replaced by a mark of its kind; overlapping spans become one mark. Null texts stay null."""
    place = df.columns.index(text)

    def clean(t: str | None) -> str | None:
        if t is None:
            return None
        out, at = [], 0
        for kind, start, end in scan(t, least_ratio):
            if start >= at:
                out += [t[at:start], f"[{kind} removed]"]
            at = max(at, end)
        return "".join(out) + t[at:] if out else t

    def redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold({})
        for part, texts in slices(batches, place):
            columns = list(part.columns)
            columns[place] = pa.array([clean(t) for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return bounded_batches(df).mapInArrow(redacted, df.schema)
