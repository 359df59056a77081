"""Personal data in texts, with DataFrame expressions only.

Regular expressions propose spans, validators confirm them (Luhn for cards, mod-97 for bank
account numbers, ranges and digit counts for the rest), and context words near a span add to
its score. The four base kinds (email, ip, card, phone) always stay; further kinds (iban,
ssn) are added where checksum or context lifts their score to ``MIN_SCORE``.

Positions come from splitting a text by the same expression that extracts the matches: a
match starts after all pieces and matches before it. The expressions never rescan a run of
characters nor recurse over it, so very long texts and runs are safe, and those of the base
kinds match exactly what the plain leftmost, non-overlapping forms match.

A bank account number may be followed by a space and capitals or digits of the text, so its
expression only finds where one may begin. It ends where mod-97 holds: at the length that its
country prescribes, or for other codes at the longest of 15 to 34 letters and digits. Every
beginning is judged by itself, so spans of two account numbers may overlap.

Rows: a null text counts as empty when searched and stays null when masked; repeated rows are
searched each; equal spans of two kinds keep the order of the kinds; other columns pass
through ``masked`` unchanged, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
MIN_SCORE = 0.5
CONTEXT_CHARS = 40

_LOCAL, _LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
PATTERNS = {
    # A run is entered at its start, or where the last match ended.
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_LABEL}]++(?:\.[{_LABEL}]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Whole runs of 14 to 19 digits with single separators; longer and shorter ones fail anyway.
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # The country and check digits of an account number; ``_account`` finds its end.
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_IP = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"

# Fixed values of the IBAN registry.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN_MIN, _IBAN_MAX = 15, 34

# Score of a confirmed span before its context, and words that raise it.
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.9, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT = {
    "email": "mail|e-mail|email|contact|write to",
    "ip": "ip|address|host|server|login",
    "card": "card|visa|mastercard|credit|payment|debit",
    "phone": "phone|tel|call|mobile|fax|whatsapp",
    "iban": "iban|account|bank|transfer|konto|cuenta|compte",
    "ssn": "ssn|social security|tax id",
}
CONTEXT_BONUS = 0.3


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    turned = F.reverse(_digits(match))
    doubled = F.translate(turned, "0123456789", "0246813579")
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(turned)),
        F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, F.substring(turned, i, F.lit(1))).otherwise(F.substring(doubled, i, F.lit(1))).cast("int"),
    )
    return total % 10 == 0


def _mod97(match: Column) -> Column:
    """Remainder of the number that an account's letters and digits, first four last, stand for."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    value = F.aggregate(
        F.sequence(F.lit(1), F.length(turned)),
        F.lit(0),
        lambda acc, i: F.when(
            F.ascii(F.substring(turned, i, F.lit(1))) < 65, acc * 10 + F.ascii(F.substring(turned, i, F.lit(1))) - 48
        ).otherwise(acc * 100 + F.ascii(F.substring(turned, i, F.lit(1))) - 55)
        % 97,
    )
    return value == 1


def _account(text: Column, start: Column) -> Column:
    """The account number that begins at ``start``, empty if there is none."""
    # One sign more than the longest with all its spaces, to see that it ends there.
    ahead = F.substring(text, (start + 1).cast("int"), F.lit(2 * _IBAN_MAX))
    run = F.regexp_extract(ahead, rf"^[A-Z0-9](?:\x20?[A-Z0-9]){{0,{_IBAN_MAX - 1}}}+", 0)
    country = F.substring(ahead, 1, 2)
    prescribed = F.lit(None).cast("int")
    for size, codes in IBAN_LENGTHS.items():
        prescribed = F.when(country.isin(*codes.split()), size).otherwise(prescribed)

    def ends(n: Column) -> Column:
        size = F.length(F.replace(F.substring(run, F.lit(1), n), F.lit(" "), F.lit("")))
        return (
            F.substring(ahead, n, F.lit(2)).rlike("^[A-Z0-9](?![A-Za-z0-9])")
            & size.between(_IBAN_MIN, _IBAN_MAX)
            & (size == F.coalesce(prescribed, size))
            & _mod97(F.substring(run, F.lit(1), n))
        )

    longest_first = F.sequence(F.length(run), F.lit(1), F.lit(-1))
    return F.substring(run, F.lit(1), F.coalesce(F.try_element_at(F.filter(longest_first, ends), F.lit(1)), F.lit(0)))


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(_IP)
    if kind == "card":
        return _luhn(match)
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "iban":
        return F.length(match) > 0
    if kind == "ssn":
        return ~match.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _spans(kind: str, text: Column, matches: Column) -> Column:
    """Confirmed spans: start, rank of the kind, kind, stop, score."""
    pieces = F.split(text, PATTERNS[kind], -1)
    zero = F.lit(0).cast("long")
    none = F.array().cast("array<struct<start:long,stop:long,found:string>>")
    walked = F.aggregate(
        F.arrays_zip(matches.alias("m"), F.slice(pieces, 1, F.size(matches)).alias("p")),
        F.struct(zero.alias("upto"), none.alias("spans")),
        lambda acc, x: F.struct(
            (acc["upto"] + F.length(x["p"]) + F.length(x["m"])).alias("upto"),
            F.concat(
                acc["spans"],
                F.array(
                    F.struct(
                        (acc["upto"] + F.length(x["p"])).alias("start"),
                        (acc["upto"] + F.length(x["p"]) + F.length(x["m"])).alias("stop"),
                        x["m"].alias("found"),
                    )
                ),
            ).cast("array<struct<start:long,stop:long,found:string>>"),
        ),
        lambda acc: acc["spans"],
    )

    def scored(s: Column) -> Column:
        begin = F.greatest(s["start"] - CONTEXT_CHARS, zero)
        near = F.concat_ws(
            " ",
            F.substring(text, (begin + 1).cast("int"), (s["start"] - begin).cast("int")),
            F.substring(text, (s["stop"] + 1).cast("int"), F.lit(CONTEXT_CHARS)),
        )
        helped = F.lower(near).rlike(rf"\b(?:{CONTEXT[kind]})\b")
        return F.struct(
            s["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            F.lit(kind).alias("kind"),
            s["stop"].alias("stop"),
            (F.lit(SCORES[kind]) + F.when(helped, CONTEXT_BONUS).otherwise(0.0)).alias("score"),
        )

    if kind == "iban":

        def whole(s: Column) -> Column:
            found = _account(text, s["start"])
            return F.struct(s["start"].alias("start"), (s["start"] + F.length(found)).alias("stop"), found.alias("found"))

        walked = F.transform(walked, whole)
    kept = F.transform(F.filter(walked, lambda s: _confirmed(kind, s["found"])), scored)
    if kind not in BASE_KINDS:
        kept = F.filter(kept, lambda s: s["score"] >= MIN_SCORE)
    empty = F.array().cast("array<struct<start:long,rank:int,kind:string,stop:long,score:double>>")
    return F.when(F.size(matches) > 0, kept).otherwise(empty)


def with_spans(docs: DataFrame, text: str = "text", spans: str = "pii_spans") -> DataFrame:
    """``docs`` with an array ``spans`` of (start, rank, kind, stop, score) by start and kind.

    Positions are code points, the end exclusive. ``spans`` must not be a column of ``docs``.
    """
    if spans in docs.columns:
        raise ValueError(f"column {spans!r} exists already")
    whole = F.coalesce(F.col(text), F.lit(""))
    no_match = F.array().cast("array<string>")
    matches = {
        k: (F.when(F.contains(whole, F.lit(NEEDS[k])), F.regexp_extract_all(whole, F.lit(PATTERNS[k]), F.lit(0))).otherwise(no_match))
        if k in NEEDS
        else F.regexp_extract_all(whole, F.lit(PATTERNS[k]), F.lit(0))
        for k in KINDS
    }
    held = docs.select("*", *[m.alias(f"{spans}_{k}") for k, m in matches.items()])
    found = held.select(*docs.columns, *[_spans(k, whole, F.col(f"{spans}_{k}")).alias(f"{spans}_{k}") for k in KINDS])
    return found.select(*docs.columns, F.array_sort(F.concat(*[F.col(f"{spans}_{k}") for k in KINDS])).alias(spans))


def masked(docs: DataFrame, text: str = "text", spans: str = "pii_spans") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets, overlapping spans by the
    kind of the first. All columns stay; n_chars, where there is one, follows the new text."""
    found = with_spans(docs, text, spans)
    zero = F.lit(0).cast("long")
    # Walk the spans in order, copying what lies between them.
    start = F.struct(zero.alias("upto"), F.array().cast("array<string>").alias("parts"))
    walked = F.aggregate(
        F.col(spans),
        start,
        lambda acc, s: F.when(
            s["start"] >= acc["upto"],
            F.struct(
                s["stop"].alias("upto"),
                F.concat(
                    acc["parts"],
                    F.array(
                        F.substring(F.col(text), (acc["upto"] + 1).cast("int"), (s["start"] - acc["upto"]).cast("int")),
                        F.concat(F.lit("<"), s["kind"], F.lit(">")),
                    ),
                ).alias("parts"),
            ),
        ).otherwise(F.struct(F.greatest(acc["upto"], s["stop"]).alias("upto"), acc["parts"].alias("parts"))),
        lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substr(F.col(text), (acc["upto"] + 1).cast("int"))),
    )
    out = found.withColumn(text, F.when(F.size(spans) > 0, walked).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length(text).cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of ``kinds``, comma-joined."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
