"""Personal data by weak supervision, in column expressions.

Spans of four kinds (email, ip, card, phone) are found by the base patterns and,
as candidates only, by looser patterns (spelled-out mail addresses, spaced
addresses, dotted or mistyped card numbers, national phone numbers).  Base spans
that pass their check are always reported.  Five labelers look at every span:

- ``pattern``: the strict pattern and its check hold;
- ``checksum``: Luhn digit, octets up to 255, 10 to 15 digits, a dotted domain;
- ``layout``: the usual grouping of digits, or a mail address without blanks;
- ``gazetteer``: known top-level domains, card issuer digits, public address
  blocks, phone prefixes that exist;
- ``context``: words such as "mail", "call" or "card" just before the span speak
  for it, words such as "version", "order" or "isbn" against it.

Each votes yes, no or abstains.  Expectation-maximisation over the counts of
vote patterns (a few hundred at most, whatever the corpus) estimates how often
the labelers are right and how likely each pattern is personal data.  A logistic
classifier over the votes and the kind is then trained on those probabilities
and decides, as a column expression, which candidates are added.

Positions are code points, end exclusive, from the lengths of the matches and of
what lies between them.  Patterns are written with possessive repeats and look
at the start of a run only, which finds the same spans in linear time.

Defined cases: null text counts as empty and has no spans; failing base matches
are dropped and not tried again; candidates that touch a base span are dropped;
the same place may carry spans of several kinds; repeated rows are reported one
by one; a corpus without candidates adds nothing; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ventilake.llm.common import checkpointed, id_text

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "checksum", "layout", "gazetteer", "context")
#: the base patterns, and what a text must contain for them
BASE = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "."),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[(\[]at[)\]] ?| at )[A-Za-z0-9-]++(?:(?: ?[(\[]dot[)\]] ?| dot )[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?: ?[(\[]dot[)\]] ?[0-9]{1,3}+){3}|(?<![0-9.])[0-9]{1,3}+(?: \. [0-9]{1,3}+){3}",
    "card": r"(?<![0-9.-])[0-9]{4}(?:[. -][0-9]{4}){3}(?![0-9])|(?<![0-9])[3-6][0-9]{12,18}+(?![0-9])",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])|(?<![0-9+])0[1-9][0-9]{1,3}[ /-][0-9]{5,8}(?![0-9])",
}
TLDS = ("com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "it", "uk", "eu", "ch", "at", "nl", "us", "ca")
CONTEXT = {
    "email": r"(?i)(?:mail|contact|write|address)[^\n]{0,20}$",
    "ip": r"(?i)(?:\bip\b|host|server|login|address)[^\n]{0,20}$",
    "card": r"(?i)(?:card|visa|credit|debit|payment)[^\n]{0,20}$",
    "phone": r"(?i)(?:phone|call|tel|mobile|fax|contact)[^\n]{0,20}$",
}
AGAINST = r"(?i)(?:version|isbn|order|serial|invoice|article|chapter|\bno\.)[^\n]{0,12}$"
_REACH = 32
#: matches whose positions are added up in one array
_BLOCK = 512


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits ends in its Luhn digit."""

    def value(i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), lambda acc, i: acc + F.coalesce(value(i), F.lit(0)))
    return total % 10 == 0


def _octets(text: Column) -> Column:
    part = lambda p: F.length(F.regexp_replace(p, "^0+", ""))
    return F.forall(F.split(text, r"[^0-9]+"), lambda p: (part(p) <= 3) & (F.coalesce(F.substring(F.regexp_replace(p, "^0+", ""), 1, 3).cast("int"), F.lit(0)) <= 255))


def _checked(kind: str, text: Column) -> Column:
    """Whether a base match of ``kind`` passes."""
    n = F.length(_digits(text))
    return {
        "email": F.lit(True),
        "ip": _octets(text),
        "card": n.between(14, 19) & _luhn(_digits(text)),
        "phone": n.between(10, 15),
    }[kind]


_SPAN = "struct<start:int,end:int,match:string,before:string>"


def _found(text: Column, pattern: str, needs: str | None) -> Column:
    """All matches as ``array<struct<start, end, match, before>>``; ``before``: up to ``_REACH`` characters in front.

    Linear in the text: an array grows by copying, so positions are added up within
    blocks of matches, and what stands before a block from the blocks' lengths."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if needs is not None:
        matches = F.when(F.contains(text, F.lit(needs)), matches).otherwise(F.array().cast("array<string>"))
    between = F.split(text, pattern, -1)
    sizes = F.zip_with(F.slice(between, F.lit(1), F.size(matches)), matches, lambda b, m: F.struct(F.length(b).alias("gap"), F.right(b, F.lit(_REACH)).alias("b"), m.alias("m")))
    empty = F.array().cast(f"array<{_SPAN}>")
    tail = lambda *parts: F.right(F.concat(*parts), F.lit(_REACH)).alias("tail")

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["m"])
        span = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("match"), tail(acc["tail"], x["b"]).alias("before"))
        return F.struct(end.alias("at"), tail(acc["tail"], x["b"], x["m"]), F.concat(acc["out"], F.array(span)).alias("out"))

    def placed(block: Column, at: Column, before: Column) -> Column:
        return F.aggregate(block, F.struct(at.alias("at"), before.alias("tail"), empty.alias("out")), add, lambda acc: acc["out"])

    def in_blocks(sizes: Column) -> Column:
        n_blocks = F.ceil(F.size(sizes) / _BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda i: F.slice(sizes, i * _BLOCK + 1, F.lit(_BLOCK)))
        nothing = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"))
        over = lambda acc, x: F.struct((acc["at"] + x["gap"] + F.length(x["m"])).alias("at"), tail(acc["tail"], x["b"], x["m"]))
        wholes = F.transform(blocks, lambda block: F.aggregate(block, nothing, over))
        begin = F.struct(*[F.lit(v).alias(n) for n, v in (("at", 0), ("tail", ""))], F.array().cast("array<struct<at:int,tail:string>>").alias("out"))

        def follow(acc: Column, x: Column) -> Column:
            here = F.array(F.struct(acc["at"].alias("at"), acc["tail"].alias("tail")))
            return F.struct((acc["at"] + x["at"]).alias("at"), tail(acc["tail"], x["tail"]), F.concat(acc["out"], here).alias("out"))

        begins = F.aggregate(wholes, begin, follow, lambda acc: acc["out"])
        return F.flatten(F.zip_with(blocks, begins, lambda block, at: placed(block, at["at"], at["tail"])))

    # a lambda's variable is computed once, an expression inside a lambda once for every element
    found = F.transform(F.array(sizes), lambda s: F.when(F.size(s) > _BLOCK, in_blocks(s)).otherwise(placed(s, F.lit(0), F.lit(""))))
    return F.when(F.size(matches) > 0, F.get(found, F.lit(0))).otherwise(empty)


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, 1)
    return (out.when(no, -1) if no is not None else out).otherwise(-1 if no is None else 0).cast("int")


def _votes(kind: str, span: Column, strict: bool) -> list[Column]:
    """The labelers' votes on a span, in the order of ``LABELERS``: 1 yes, -1 no, 0 abstains."""
    m = span["match"]
    digits, before = _digits(m), span["before"]
    last = F.lower(F.regexp_extract(m, r"([A-Za-z0-9-]+)$", 1))
    checksum = {
        "email": m.rlike(r"(?:\.|dot[)\]]?) ?[A-Za-z]{2,}$"),
        "ip": F.size(F.filter(F.split(m, "[^0-9]+"), lambda p: F.length(p) <= 3)) == 4,
        "card": _luhn(digits),
        "phone": F.length(digits).between(10, 15),
    }[kind]
    layout = {
        "email": ~F.contains(m, F.lit(" ")),
        "ip": m.rlike(r"^[0-9.]+$"),
        "card": m.rlike(r"^(?:[0-9]{14,19}|[0-9]{4}(?:[ -][0-9]{4}){3})$"),
        "phone": m.rlike(r"^(?:\+[0-9]{1,3}[ -]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}$"),
    }[kind]
    gazetteer = {
        "email": last.isin(*TLDS),
        "ip": ~m.rlike(r"^(?:0|127|22[4-9]|2[3-5][0-9])[^0-9]"),
        "card": digits.rlike(r"^(?:4|5[1-5]|2[2-7]|3[47]|30|3[68]|6)"),
        "phone": ~digits.rlike(r"^(?:0{2,}|1?[01][0-9]{9}$)"),
    }[kind]
    context = F.when(before.rlike(AGAINST), -1).when(before.rlike(CONTEXT[kind]), 1).otherwise(0).cast("int")
    return [F.lit(1 if strict else 0), _vote(checksum), _vote(layout), _vote(gazetteer), context]


def _spans(text: Column, kind: str, strict: bool) -> Column:
    """Spans of a kind with their votes; base matches that fail their check are left out."""
    pattern, needs = BASE[kind] if strict else (LOOSE[kind], None)
    found = _found(text, pattern, needs)
    if strict:
        found = F.filter(found, lambda s: _checked(kind, s["match"]))

    def voted(s: Column) -> Column:
        votes = [v.alias(n) for n, v in zip(LABELERS, _votes(kind, s, strict), strict=True)]
        return F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end"), F.lit(strict).alias("base"), *votes)

    return F.transform(found, voted)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, extra``: base spans, and candidates that touch none of them, with votes."""
    rows = id_text(docs, id_col, text_col)
    base = reduce(F.concat, [_spans(F.col("text"), k, True) for k in KINDS])
    loose = reduce(F.concat, [_spans(F.col("text"), k, False) for k in KINDS])
    rows = rows.select("doc_id", base.alias("base"), loose.alias("loose"))
    free = F.filter("loose", lambda x: ~F.exists("base", lambda b: (x["start"] < b["end"]) & (b["start"] < x["end"])))
    return rows.select("doc_id", "base", free.alias("extra"))


def expectation_maximisation(patterns: dict[tuple, int], rounds: int = 50) -> dict[tuple, float]:
    """Probability of each ``(kind, votes...)`` pattern to be personal data, from the patterns' counts alone.

    Labelers err independently given the truth; what a labeler says (yes, no,
    nothing) has one distribution for true and one for false spans.  The start
    is the share of yes among the votes cast."""
    p = {}
    for key in patterns:
        cast = [v for v in key[1:] if v]
        p[key] = (sum(v > 0 for v in cast) + 0.5) / (len(cast) + 1.0)
    for _ in range(rounds):
        total = sum(patterns.values())
        prior = (sum(n * p[k] for k, n in patterns.items()) + 1.0) / (total + 2.0)
        said = {}
        for j in range(len(LABELERS)):
            for v in (-1, 0, 1):
                yes = sum(n * p[k] for k, n in patterns.items() if k[1 + j] == v)
                no = sum(n * (1 - p[k]) for k, n in patterns.items() if k[1 + j] == v)
                # labelers are held to be better than chance: a vote starts with a count in its favour
                said[j, v] = ((yes + (2.0 if v > 0 else 1.0)) / (total * prior + 4.0), (no + (2.0 if v < 0 else 1.0)) / (total * (1 - prior) + 4.0))
        for key in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(said[j, v][0] / said[j, v][1]) for j, v in enumerate(key[1:]))
            p[key] = 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, odds))))
    return p


def span_classifier(patterns: dict[tuple, int], truth: dict[tuple, float], steps: int = 300, rate: float = 0.5, l2: float = 1e-3) -> list[float]:
    """Weights of intercept, labelers and kinds: logistic regression on the probabilities, patterns weighted by log count."""
    rows = [([1.0, *map(float, k[1:]), *(float(k[0] == i) for i in range(len(KINDS)))], truth[k], math.log1p(n)) for k, n in sorted(patterns.items())]
    w = [0.0] * (1 + len(LABELERS) + len(KINDS))
    whole = sum(n for _, _, n in rows) or 1.0
    for _ in range(steps):
        grad = [l2 * x for x in w]
        for x, y, n in rows:
            p = 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x, strict=True))))))
            grad = [g + n / whole * (p - y) * b for g, b in zip(grad, x, strict=True)]
        w = [a - rate * g for a, g in zip(w, grad, strict=True)]
    return w


def pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, counts of base spans by kind, ``base_sha256``, ``spans`` (base and added), ``n_added``."""
    found = checkpointed(spans(docs, id_col, text_col))
    each = found.select(F.explode(F.concat("base", "extra")).alias("s")).select("s.kind", *[f"s.{n}" for n in LABELERS])
    counts = {tuple(r[:-1]): r[-1] for r in each.groupBy("kind", *LABELERS).count().collect()}
    w = span_classifier(counts, expectation_maximisation(counts))

    def accepted(s: Column) -> Column:
        of_kind = F.element_at(F.array(*[F.lit(x) for x in w[1 + len(LABELERS) :]]), s["kind"] + 1)
        return F.lit(w[0]) + of_kind + sum((F.lit(x) * s[n] for x, n in zip(w[1:], LABELERS, strict=False)), F.lit(0.0)) >= 0

    def joined(array: Column) -> Column:
        names = F.array(*[F.lit(k) for k in KINDS])
        place = F.transform(array, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
        return F.array_join(F.transform(F.array_sort(place), lambda s: F.concat(F.element_at(names, s["kind"] + 1), F.lit(":"), s["start"], F.lit(":"), s["end"])), ",")

    added = F.filter("extra", accepted)
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.concat(F.col("base"), added)).alias("spans"),
        F.size(added).cast("long").alias("n_added"),
    )
