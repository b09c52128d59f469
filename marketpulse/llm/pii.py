"""Personal data with DataFrame functions only: patterns propose, checksums
confirm, nearby words adjust.

For each kind, the matches of its pattern and the gaps between them give the
positions (code points, end exclusive). Checks then confirm a proposal: number
ranges, digit counts, Luhn for cards, mod 97 for IBANs. Every span has a score:
the kind's own, plus a bonus when a word that announces the kind stands shortly
before it. Base kinds (email, ip, card, phone) stay at any score once their
check passes; the added kinds (iban, ssn) stay from ``KEEP_SCORE`` on.

Edge cases: NULL is an empty text, without spans; repeated rows give the same
spans; an empty table gives an empty result. Positions are running sums taken block
by block and texts are cut into pieces once, so work follows the text's length however
many matches it has. Patterns start only where a run of
their characters starts and never give back what they took, so a text that is
one long run costs one pass. IBANs are the exception: each head (two letters, two
digits) where a word starts proposes the text from there, whatever other heads
propose, and spans that overlap an IBAN before them fall away. A country of the
registry fixes the length; for other codes the longest part that ends where a word
ends and passes mod 97 counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import id_text, sha256_hex

KEEP_SCORE = 0.6
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.25
SPAN = "struct<start:int,rank:int,end:int,kind:string,score:double>"


#: Elements of a block of a running sum, and characters of a piece of text.
BLOCK = 64
PIECE = 256
MATCH = "struct<start:int,end:int,m:string>"


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(items: Column, zero: Column, step, emit, kind: str) -> Column:
    """Array of ``emit(state, x)`` for each x of ``items``; ``step(state, x)`` is the state before the next one.

    An array that grows by one element is copied each time, so only blocks of ``BLOCK`` elements and the list of the
    blocks' first states grow that way."""
    def blocks(xs):
        starts = F.when(F.size(xs) > 0, F.sequence(F.lit(1), F.size(xs), F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.slice(xs, i, F.lit(BLOCK)))

    def states(bs):
        start = F.struct(zero.alias("at"), F.array().cast("array<int>").alias("all"))
        return F.aggregate(bs, start, lambda a, b: F.struct(
            F.aggregate(b, a["at"], step).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")), lambda a: a["all"])

    def block(z):
        start = F.struct(z["state"].alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(z["xs"], start, lambda a, x: F.struct(
            step(a["at"], x).alias("at"), F.concat(a["out"], F.array(emit(a["at"], x).cast(kind))).alias("out")), lambda a: a["out"])
    return bound(items, lambda xs: bound(blocks(xs), lambda bs: F.flatten(
        F.transform(F.arrays_zip(bs.alias("xs"), states(bs).alias("state")), block))))


def pieces(text: Column) -> Column:
    """The text as an array of strings of ``PIECE`` characters, the last one shorter."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def cut(text_pieces: Column, start: Column, length: Column) -> Column:
    """``length`` characters from ``start`` (from 0), without a walk from the start of the text."""
    first = F.floor(start / PIECE).cast("int")
    n = F.floor((start + length) / PIECE).cast("int") - first + 1
    return F.substring(F.array_join(F.slice(text_pieces, first + 1, n), ""), start - first * PIECE + 1, length)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def add(acc, i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN (upper case, without spaces) leaves 1 when divided by 97."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def add(acc, i):
        c = F.substring(turned, i, F.lit(1))
        return F.when(c.rlike("[0-9]"), (acc * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97).otherwise(
            (acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _ip_ok(m: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return m.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _card_ok(m: Column) -> Column:
    d = _digits(m)
    return F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False))


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str            # a cheap test that every text with a match passes
    check: object
    score: float
    context: str         # words that announce the kind
    base: bool = True
    head: int = 0        # characters a match takes, if its group 1 looks further
    part: object = None  # the confirmed start of a proposal, empty if none is


#: IBAN registry: length to country codes.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_REGISTERED = "(?:" + "|".join(" ".join(IBAN_LENGTHS.values()).split()) + ")"
_IBAN = "|".join([rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items()]
                 + [rf"(?!{_REGISTERED})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}"])


def iban_part(m: Column) -> Column:
    """The longest start of ``m`` that is an IBAN; all of it or nothing for a registered country."""
    def ok(n):
        code = F.regexp_replace(F.substring(m, F.lit(1), n), " ", "")
        ends = (n == F.char_length(m)) | (~m.rlike("^" + _REGISTERED) & (F.substring(m, n + 1, F.lit(1)) == " "))
        return ends & (F.char_length(code) >= 15) & mod97(code)
    longest = F.get(F.filter(F.sequence(F.char_length(m), F.lit(15), F.lit(-1)), ok), F.lit(0))
    return F.substring(m, F.lit(1), F.coalesce(longest, F.lit(0)))


# The kinds in their order, with their patterns. The base patterns
# equal email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+,
# ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), card [0-9]([\x20-]?[0-9])+ and
# phone \+[0-9][\x20().0-9-]+[0-9], written without needless backtracking.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", lambda m: F.lit(True), 0.7, "mail|contact|write|reach"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         r"[0-9]\.[0-9]++\.[0-9]", _ip_ok, 0.6, r"\bip\b|address|host|server"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++",
         r"[0-9](?:[\x20-]?[0-9]){11}", _card_ok, 0.7, "card|visa|payment|credit"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]",
         r"\+[0-9]", lambda m: F.length(_digits(m)).between(9, 15), 0.6, "call|phone|tel|mobile"),
    Kind("iban", rf"(?<![A-Za-z0-9])(?=((?:{_IBAN})(?![A-Za-z0-9])))[A-Z]{{2}}[0-9]{{2}}",
         r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]", lambda m: m != "", 0.75, "iban|account|bank", False, 4, iban_part),
    Kind("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
         r"[0-9]{3}-[0-9]{2}-", lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"), 0.4,
         "ssn|social security|taxpayer", False),
)


def _proposals(text: Column, kind: Kind) -> Column:
    """Array of (start, end, m) of the kind's matches, leftmost first and, but for kinds with a head, apart."""
    gaps = F.split(text, kind.pattern, -1)
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(1 if kind.head else 0))
    begin = lambda at, x: at + F.char_length(x["gap"])
    end = lambda at, x: begin(at, x) + F.char_length(F.coalesce(x["m"], F.lit("")))
    after = (lambda at, x: begin(at, x) + kind.head) if kind.head else end
    here = lambda at, x: F.struct(begin(at, x).alias("start"), end(at, x).alias("end"), x["m"].alias("m"))
    # m is NULL in the last pair: there is one gap more than there are matches.
    return F.filter(running(F.arrays_zip(gaps.alias("gap"), found.alias("m")), F.lit(0), after, here, MATCH),
                    lambda x: x["m"].isNotNull())


def _parts(proposals: Column, kind: Kind) -> Column:
    """The confirmed parts of proposals that may overlap, leftmost first and apart."""
    def confirmed(x):
        part = kind.part(x["m"])
        return F.struct(x["start"].alias("start"), (x["start"] + F.char_length(part)).alias("end"), part.alias("m"))

    right = F.filter(F.transform(proposals, confirmed), lambda x: kind.check(x["m"]))
    step = lambda at, x: F.when(x["start"] >= at, x["end"]).otherwise(at)
    return F.filter(running(right, F.lit(0), step, lambda at, x: F.when(x["start"] >= at, x), MATCH), lambda x: x.isNotNull())


def find_spans(src: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``spans``, an array of (start, rank, end, kind, score) in order."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast(f"array<{MATCH}>")
    lists = [F.when(text.contains(k.hint) if k.hint == "@" else text.rlike(k.hint), _proposals(text, k))
             .otherwise(none).alias(f"_p{r}") for r, k in enumerate(KINDS)]
    some = F.lit(False)
    for r in range(len(KINDS)):
        some = some | (F.size(f"_p{r}") > 0)
    step = src.select("*", *lists).select("*", F.when(some, pieces(text)).alias("_pieces"))

    def spans(rank: int, kind: Kind) -> Column:
        def scored(x):
            before = cut(F.col("_pieces"), F.greatest(x["start"] - CONTEXT_CHARS, F.lit(0)), F.least(x["start"], F.lit(CONTEXT_CHARS)))
            bonus = F.when(F.lower(before).rlike(kind.context), CONTEXT_BONUS).otherwise(0.0)
            return F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"),
                            F.lit(kind.name).alias("kind"), (F.lit(kind.score) + bonus).alias("score"))
        proposed = F.col(f"_p{rank}")
        right = _parts(proposed, kind) if kind.part else F.filter(proposed, lambda x: kind.check(x["m"]))
        good = F.transform(right, scored)
        return good if kind.base else F.filter(good, lambda s: s["score"] >= KEEP_SCORE)
    return (step.select("*", F.array_sort(F.concat(*[spans(r, k) for r, k in enumerate(KINDS)])).cast(f"array<{SPAN}>").alias("spans"))
            .drop("_pieces", *[f"_p{r}" for r in range(len(KINDS))]))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores): one row per input row."""
    found = find_spans(id_text(docs, id_col, text_col))
    base = [k.name for k in KINDS if k.base]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in base],
        sha256_hex(_joined(F.filter("spans", lambda s: s["kind"].isin(base)))).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        F.transform("spans", lambda s: s["score"]).alias("scores"))


def masked(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; overlapping spans leave one mark."""
    def marked(of):
        mark = lambda at, s: F.when(s["start"] >= at, F.concat(
            cut(of, at, s["start"] - at), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")
        end = F.coalesce(F.array_max(F.transform(spans, lambda s: s["end"])), F.lit(0))
        return F.concat(F.array_join(running(spans, F.lit(0), lambda at, s: F.greatest(at, s["end"]), mark, "string"), ""),
                        cut(of, end, F.char_length(text) - end))
    return bound(pieces(text), marked)


def mask_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data masked in the text; all other columns as they were."""
    whole = F.struct(*[docs[c] for c in docs.columns])
    src = find_spans(docs.select(docs[text_col].alias("text"), whole.alias("_row")))
    # NULL stays NULL, and a text without spans is passed on as it is.
    clean = F.when(F.size("spans") == 0, F.col("text")).otherwise(masked(F.col("text"), F.col("spans")))
    out = [clean.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns]
    return src.select(*out)
