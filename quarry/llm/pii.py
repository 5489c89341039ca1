"""Personal data spans: pattern matches, and more spans by weak supervision.

Emails, IP addresses, card and phone numbers are found by fixed patterns; those
base spans always stay. Looser patterns propose more spans (written-out emails,
national phone numbers, social security numbers, bank accounts, names of
persons). Labelers vote on every span, base spans included, as to whether it is
personal: its strict form (regex), membership in short lists (gazetteer), and
words before, words after and characters around it (context). Expectation
maximisation over the counts of vote patterns estimates how reliable each
labeler is for each kind, without labels. The posteriors then train a logistic
span classifier over votes and shape, and proposed spans that it scores at
``THRESHOLD`` or above, and that touch no base span, are added.

Java's matcher gives no positions, so a text is split by the pattern and the
lengths of gaps and matches are summed; that happens only for texts with a match.
Patterns enter a run of characters at its start only (or where the last match
ended), with possessive repeats, so long runs take linear time and no stack.

The vote patterns are a fixed number of combinations, counted over all documents;
their counts are all that reaches the driver. Only DataFrame and SQL functions.
Defined cases: null text counts as empty; spans are code points, end exclusive;
without any proposals, or where no labeler votes for one, nothing is added;
repeated rows give repeated rows; empty tables give empty results. Extra columns
are not read.
"""

from __future__ import annotations

import math
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import fresh, let, quoted, text_of
from quarry.operators.staging import stage

BASE = ("email", "ip", "card", "phone")
ADDED = ("mail_words", "phone_local", "ssn", "account", "person")
THRESHOLD = 0.5
CONTEXT = 40  # characters looked at before and after a span

_GAP = r"[\x20\u00A0\u202F]"
# National numbers: 3-3-4; a leading zero and pairs, an area and one block, or 8 to 12 digits in any groups, but no date;
# nine digits in the groups used without a leading zero.
_NATIONAL = "|".join((
    r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
    rf"(?<![0-9]/)(?!0[1-9](?:{_GAP}|[./-])[01]?[0-9](?:{_GAP}|[./-])(?:19|20)[0-9]{{2}}(?![0-9]))(?:"
    rf"0[1-9](?:(?:{_GAP}|[.-])[0-9]{{2}}){{4}}(?![0-9])"
    rf"|\(?0[1-9][0-9]{{0,4}}\)?(?:{_GAP}?[/-]{_GAP}?|{_GAP})[0-9]{{5,8}}(?:-[0-9]{{1,4}})?(?![0-9])"
    rf"|\(?0[1-9](?:\)?{_GAP}?[./-]?{_GAP}?[0-9]){{6,10}})",
    rf"[6-9][0-9]{{2}}(?:(?:{_GAP}|[.-])?[0-9]{{3}}){{2}}",
    rf"[6-9][0-9]{{2}}(?:(?:{_GAP}|[.-])[0-9]{{2}}){{3}}",
    rf"[89][0-9](?:{_GAP}|[.-])[0-9]{{3}}(?:(?:{_GAP}|[.-])[0-9]{{2}}){{2}}"))
# A capitalised word of a name: Müller, McDonald, O'Brien, García-Márquez.
_NAME = r"(?:\p{Lu}['’])?+\p{Lu}\p{M}*+[\p{Ll}\p{M}]++(?:[-'’]?+\p{Lu}\p{M}*+[\p{Ll}\p{M}]++)*+"
_NO_LETTER = r"(?![\p{L}\p{M}])"

# The base patterns. Each is entered at the start of a run or where the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # What the method proposes beyond them.
    "mail_words": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:[\[(]dot[\])]|\.)\x20?[A-Za-z0-9-]++)++",
    "phone_local": rf"(?<![0-9\p{{L}}\p{{M}}+.-])(?:{_NATIONAL})(?![0-9\p{{L}}-])",
    "ssn": r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "account": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "person": rf"(?<![\p{{L}}\p{{M}}]){_NAME}\.?\x20{_NAME}{_NO_LETTER}(?:\x20{_NAME}{_NO_LETTER})?+",
}
# A cheap necessary condition per kind, so that most texts skip the pattern.
GATES = {
    "email": "@", "phone": "+", "mail_words": "at",
    "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone_local": rf"[0-9]{{3}}[\x20.-][0-9]{{4}}|0[1-9](?:\)?{_GAP}?[./-]?{_GAP}?[0-9]){{6}}|[6-9][0-9](?:(?:{_GAP}|[.-])?[0-9]){{7}}", "ssn": r"-[0-9]{2}-[0-9]{4}",
    "account": r"[A-Z]{2}[0-9]{2}", "person": r"[\p{Ll}\p{M}]\.?\x20\p{Lu}['’\p{Ll}\p{M}]",
}
_LITERAL = ("email", "phone")

# The gazetteers and context words.
FIRST_NAMES = (
    "Ahmed Alice Andrew Anna Anthony Barbara Carlos Charles Daniel David Deborah Donald Dorothy Elizabeth Emily Emma Fatima George "
    "Hans Helen James Jane Jean Jennifer Jessica Johann John Jose Joseph Juan Julia Karen Klaus Laura Linda Lisa Margaret Maria "
    "Mark Mary Michael Mohammed Nancy Olivia Patricia Paul Peter Pierre Richard Robert Ruth Sandra Sarah Sofia Sophie Steven "
    "Susan Thomas Ursula William").split()
TITLES = "Dr Frau Herr Madame Miss Mr Mrs Ms Prof Señor Señora".split()
DOMAINS = "biz ch co com de edu es eu fr gov info io it net nl org uk us".split()
ACCOUNT_COUNTRIES = "AT BE CH CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT RO SE SI SK".split()
BEFORE = {
    "email": "mail contact kontakt correo courriel write reach", "ip": "ip address host server client login from",
    "card": "card visa mastercard amex credit karte tarjeta carte payment", "phone": "phone tel call mobile cell fax telefon contact",
    "mail_words": "mail contact kontakt correo courriel write reach", 
    "phone_local": "phone tel call mobile cell fax telefon contact tél téléphone teléfono móvil portable handy rufnummer kontakt",
    "ssn": "ssn social security tax taxpayer", "account": "iban account bank konto cuenta compte transfer",
    "person": "name named mr mrs ms dr prof patient customer employee signed dear sincerely regards born"}
AGAINST = "version release isbn issn order invoice item sku part serial page figure table chapter ticket build lat lon"


# -------------------------------------------------------------------- spans

def _summed_before(values: Column) -> Column:
    """For each of an array of longs, the sum of those before it. Each step copies what it has built."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.from_json(F.lit("[]"), "array<bigint>").alias("sums"))
    return F.aggregate(values, zero, lambda a, v: F.struct(
        (a["at"] + v).alias("at"), F.concat(a["sums"], F.array(a["at"])).alias("sums")))["sums"]


def running(values: Column) -> Column:
    """:func:`_summed_before` of a long array, in pieces of about the root of its length, so that what
    the steps copy stays small: 200,000 values take well under a second."""
    step = F.greatest(F.ceil(F.sqrt(F.size(values).cast("double"))).cast("int"), F.lit(1))
    pieces = let(step, lambda n: F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.size(values) - 1, F.lit(0)) / n).cast("int")), lambda i: F.slice(values, i * n + 1, n)))
    totals = lambda cut: F.transform(cut, lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda a, v: a + v))
    return let(pieces, lambda cut: let(_summed_before(totals(cut)), lambda starts: F.flatten(F.zip_with(
        cut, starts, lambda p, start: F.transform(_summed_before(p), lambda v: v + start)))))


def _found(text: Column, kind: str) -> Column:
    """Array of (start, end, hit, before, after) for the matches of a kind's pattern."""
    pattern = PATTERNS[kind]
    gate = text.contains(GATES[kind]) if kind in _LITERAL else text.rlike(GATES[kind])
    empty = F.from_json(F.lit("[]"), "array<struct<start:bigint,end:bigint,hit:string,before:string,after:string>>")

    def placed(gaps: Column, hits: Column) -> Column:
        pairs = F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gap"), hits.alias("hit"), F.slice(gaps, 2, F.size(hits)).alias("rest"))

        def span(z, at):
            gap, hit, rest = z["gap"], z["hit"], z["rest"]
            start = at + F.length(gap)
            return F.struct(start.alias("start"), (start + F.length(hit)).alias("end"), hit.alias("hit"),
                            F.right(gap, F.lit(CONTEXT)).alias("before"), F.left(rest, F.lit(CONTEXT)).alias("after"))

        return let(pairs, lambda zs: F.zip_with(
            zs, let(F.transform(zs, lambda z: (F.length(z["gap"]) + F.length(z["hit"])).cast("long")), running), span))

    matched = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: F.when(
        F.size(hits) > 0, let(F.split(text, pattern, -1), lambda gaps: placed(gaps, hits))).otherwise(empty))
    return F.when(gate, matched).otherwise(empty)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The check-digit sum is a multiple of ten."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: let(
        d.cast("int") * (i % 2 + 1), lambda v: F.when(v > 9, v - 9).otherwise(v)))
    return F.aggregate(each, F.lit(0), lambda a, v: a + v) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(hit, "[.]"), lambda p: F.coalesce(p.try_cast("long") <= 255, F.lit(False)))
    if kind == "card":
        return let(_digits(hit), lambda d: F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(hit)).between(10, 15)
    return F.lit(True)


# ------------------------------------------------------------------ labelers

def _any_word(text: Column, words: str) -> Column:
    return F.lower(text).rlike(r"(?<![\p{L}0-9])(?:" + "|".join(words.split()) + r")(?![\p{L}0-9])")


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, F.lit(1))
    return (out if no is None else out.when(no, F.lit(-1))).otherwise(F.lit(0))


def _listed(value: Column, words: list[str]) -> Column:
    return value.isin(*words)


# Usual layouts: North American, pairs with one separator, area and block, area and two groups.
_USUAL = (
    r"[2-9][0-9]{2}\)?[\x20.-]?[2-9][0-9]{2}[\x20.-]?[0-9]{4}$",
    rf"^0[1-9]({_GAP}|[.-])[0-9]{{2}}(?:\1[0-9]{{2}}){{3}}$",
    rf"^\(?0[1-9][0-9]{{1,4}}\)?(?:{_GAP}?[/-]{_GAP}?|{_GAP})(?:[0-9]{{5,8}}(?:-[0-9]{{1,4}})?|[0-9]{{3,4}}[\x20-][0-9]{{3,4}})$")


def _strict(kind: str, hit: Column) -> Column:
    """Regex labeler: the form that a real one has."""
    if kind in ("email", "mail_words"):
        return _vote(hit.rlike(r"^[A-Za-z0-9][^@\x20]*[A-Za-z0-9]?.*[.)\]\x20][A-Za-z]{2,}$"), hit.rlike(r"[.)\]\x20][0-9]+$"))
    if kind == "ip":
        return _vote(~hit.rlike(r"^(?:0|127|255)\.|(?:^|\.)0[0-9]"), hit.rlike(r"^0\.|(?:^|\.)0[0-9]"))
    if kind == "card":
        return _vote(hit.rlike("^[3-6]"), hit.rlike(r"^([0-9])(?:[\x20-]?\1)+$"))
    if kind == "phone_local":
        return _vote(hit.rlike("|".join(_USUAL)), hit.rlike(r"([0-9])\1{6}"))
    if kind == "phone":
        return _vote(hit.rlike(r"[2-9][0-9]{2}\)?[\x20.-]?[2-9][0-9]{2}[\x20.-]?[0-9]{4}$"), hit.rlike(r"([0-9])\1{6}"))
    if kind == "ssn":
        return _vote(~hit.rlike("^(?:000|666|9)|-00-|-0000$"), hit.rlike("^(?:000|666|9)|-00-|-0000$"))
    if kind == "account":
        return _vote(F.length(F.regexp_replace(hit, " ", "")).between(15, 34) & hit.rlike("[0-9]{6}"), ~hit.rlike("[0-9]{4}"))
    return F.lit(0)


def _unaccented(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))


_ACCENTED = "".join(c for c in map(chr, range(0xC0, 0x250)) if len(b := _unaccented(c)) == 1 and b.isascii())


def _plain(hit: Column) -> Column:
    """Latin letters without their accents, composed or not."""
    return F.translate(F.regexp_replace(hit, r"\p{M}", ""), _ACCENTED, _unaccented(_ACCENTED))


def _gazetteer(kind: str, hit: Column) -> Column:
    if kind in ("email", "mail_words"):
        return _vote(_listed(F.lower(F.regexp_extract(hit, "([A-Za-z]+)$", 1)), DOMAINS))
    if kind == "account":
        return _vote(_listed(F.substring(hit, 1, 2), ACCOUNT_COUNTRIES), F.lit(True))
    if kind == "person":
        plain = _plain(hit)
        return _vote(_listed(F.regexp_extract(plain, r"^([A-Za-z]+)", 1), [_unaccented(x) for x in FIRST_NAMES + TITLES])
                     | _listed(F.regexp_extract(plain, r"\x20([A-Za-z]+)", 1), [_unaccented(x) for x in FIRST_NAMES]), F.lit(True))
    return F.lit(0)


LABELERS = ("strict", "gazetteer", "before", "after", "around")


def _labelled(kind: str, s: Column) -> Column:
    hit, before, after = s["hit"], s["before"], s["after"]
    inside = r"[\p{L}0-9_/=#]"
    return F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        F.array(_strict(kind, hit), _gazetteer(kind, hit),
                _vote(_any_word(before, BEFORE[kind]), _any_word(before, AGAINST)),
                _vote(_any_word(after, BEFORE[kind]), _any_word(after, AGAINST)),
                _vote(F.lit(False), before.rlike(inside + "$") | after.rlike("^" + inside))).alias("votes"),
        F.array((F.length(hit) > 12).cast("int"), hit.rlike("[\\x20()]").cast("int"), hit.rlike("[0-9]").cast("int"),
                before.rlike(r"[:\n]\x20*$").cast("int")).alias("shape"))


def candidates(text: Column) -> Column:
    """Struct of base and proposed spans, each with votes and shape."""
    def of(kind):
        return F.transform(F.filter(_found(text, kind), lambda s: _valid(kind, s["hit"])), lambda s: _labelled(kind, s))
    # A proposal needs a labeler's vote for it.
    voted = F.filter(F.concat(*[of(k) for k in ADDED]), lambda s: F.array_contains(s["votes"], 1))
    return F.struct(F.concat(*[of(k) for k in BASE]).alias("base"), voted.alias("proposed"))


# ------------------------------------------------- reliabilities, classifier

def expectation_maximisation(patterns: dict[tuple[int, ...], float], rounds: int = 60) -> dict[tuple[int, ...], float]:
    """Posterior that a span is personal, per vote pattern of one kind.

    Labelers are independent given the truth; each has its rates of the three votes in
    either class. The start takes votes at face value, which fixes which class is which.
    """
    total = sum(patterns.values())
    post = {v: 1 / (1 + math.exp(-1.5 * sum(v))) for v in patterns}
    width = len(next(iter(patterns)))
    for _ in range(rounds):
        mass = sum(n * post[v] for v, n in patterns.items())
        prior = min(max((mass + 1) / (total + 2), 0.02), 0.98)
        rates = []  # per labeler: vote -> (rate if personal, rate if not)
        for j in range(width):
            yes, no = dict.fromkeys((-1, 0, 1), 0.5), dict.fromkeys((-1, 0, 1), 0.5)
            for v, n in patterns.items():
                yes[v[j]] += n * post[v]
                no[v[j]] += n * (1 - post[v])
            ys, ns = sum(yes.values()), sum(no.values())
            rate = {x: (yes[x] / ys, no[x] / ns) for x in yes}
            # A labeler is never taken to be worse than chance.
            rates.append({x: (a, b) if x == 0 or (a - b) * x >= 0 else ((a + b) / 2,) * 2 for x, (a, b) in rate.items()})
        for v in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(rates[j][x][0] / rates[j][x][1]) for j, x in enumerate(v))
            post[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return post


def _inputs(kind: str, votes, shape) -> list[float]:
    return [float(kind == k) for k in (*BASE, *ADDED)] + [float(v) for v in votes] + [float(x) for x in shape]


def logistic(rows: list[tuple[list[float], float, float]], rounds: int = 200, ridge: float = 1.0, rate: float = 0.5) -> list[float]:
    """Weights for rows of (inputs, soft label, count), by gradient steps scaled per input."""
    if not rows:
        return []
    width, total = len(rows[0][0]), sum(n for _, _, n in rows)
    w, square = [0.0] * width, [1e-8] * width
    for _ in range(rounds):
        slope = [ridge * x / total for x in w]
        for x, y, n in rows:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x))))))
            for j, v in enumerate(x):
                if v:
                    slope[j] += n * (p - y) * v / total
        for j in range(width):
            square[j] += slope[j] ** 2
            w[j] -= rate * slope[j] / math.sqrt(square[j])
    return w


def train(spans: DataFrame) -> list[float]:
    """Weights of the span classifier from a table with columns base and proposed."""
    one = spans.select(F.explode(F.concat("base", "proposed")).alias("s"))
    # At most kinds x 3^labelers x 2^shapes rows, whatever the corpus.
    counted = one.groupBy("s.kind", "s.votes", "s.shape").agg(F.count(F.lit(1)).alias("n")).orderBy("kind", "votes", "shape").collect()
    rows = []
    for kind in (*BASE, *ADDED):
        own = [r for r in counted if r["kind"] == kind]
        patterns: dict[tuple[int, ...], float] = {}
        for r in own:
            patterns[tuple(r["votes"])] = patterns.get(tuple(r["votes"]), 0) + r["n"]
        if patterns:
            post = expectation_maximisation(patterns)
            rows += [(_inputs(kind, r["votes"], r["shape"]), post[tuple(r["votes"])], r["n"]) for r in own]
    return logistic(rows)


def probability(span: Column, weights: list[float]) -> Column:
    kinds = (*BASE, *ADDED)
    margin = F.lit(0.0)
    for k, w in zip(kinds, weights):
        margin = F.when(span["kind"] == k, F.lit(float(w))).otherwise(margin)
    for part, at, n in (("votes", len(kinds), len(LABELERS)), ("shape", len(kinds) + len(LABELERS), 4)):
        for j in range(n):
            margin = margin + F.lit(float(weights[at + j])) * span[part][j]
    return 1 / (1 + F.exp(-margin))


def pii_spans(df: DataFrame, text: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns (default: all but the text), then spans: array of kind, start, end, probability
    (1 for base spans), base; by start, then kind in the order of ``BASE`` and ``ADDED``."""
    keep = [c for c in df.columns if c != text] if keep is None else keep
    c = fresh(df, "__spans")
    found = stage(df.select(*[df[quoted(k)] for k in keep], candidates(text_of(df, text)).alias(c)), "pii-spans").df
    weights = train(found.select(F.col(c)["base"].alias("base"), F.col(c)["proposed"].alias("proposed")))
    order = F.array(*[F.lit(k) for k in (*BASE, *ADDED)])

    def out(span: Column, p: Column, base: bool) -> Column:
        return F.struct(span["start"].alias("start"), F.array_position(order, span["kind"]).alias("rank"), span["end"].alias("end"),
                        span["kind"].alias("kind"), p.alias("probability"), F.lit(base).alias("base"))

    base = F.transform(F.col(c)["base"], lambda s: out(s, F.lit(1.0), True))
    more = F.slice(base, 1, 0)
    if weights:
        free = F.filter(F.col(c)["proposed"], lambda s: ~F.exists(
            F.col(c)["base"], lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
        more = F.filter(F.transform(free, lambda s: out(s, probability(s, weights), False)),
                        lambda s: s["probability"] >= threshold)
    spans = F.transform(F.sort_array(F.concat(base, more)), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["probability"].alias("probability"), s["base"].alias("base")))
    return found.select(*keep, spans.alias(fresh(df, "spans")))
