"""Personal data: base patterns, and a span classifier trained on weak labels that adds to them.

1. Patterns give candidates: the four base forms, and wider ones (spelled-out addresses, numbers in other groupings, names
   after a title or a common first name). A base candidate that passes its check is a base span and stays.
2. Labelers vote on every candidate: patterns and checks, gazetteers (domains, calling codes, issuers, names) and
   context (words that announce such data, words that announce something else). A vote is for, against, or none.
3. Expectation-maximisation over the counts of vote patterns estimates how often each labeler gives each vote on
   personal and on other spans, and the share of personal ones by kind. There are at most ``VOTES`` ** labelers patterns.
4. The posteriors are the soft labels of a naive Bayes classifier over what the labelers don't see: neighbouring
   words, shape and size, hashed to ``BUCKETS``. Candidates that it gives ``THRESHOLD`` or more are added, unless they
   touch a base span or fail the check of their kind (those only teach).

Places are found without loops: a text is split by a pattern into what lies between its matches, and a running sum over
the lengths of both gives code points. Patterns are possessive and look behind, so that each is linear in the text.

Data movement: texts are read once; only candidates with a few characters around them go on, written. Running sums and
spans are grouped by row of the table, so a group is what one text holds. Counts of votes and of features combine
map-side; the feature table has at most ``BUCKETS`` rows, hence the broadcast. The driver gets sums by labeler.

Defined results: null text is empty and has no spans; positions are code points, ends exclusive; repeated rows and
null ids are scanned like any row; without candidates nothing is learned or added; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import doc_key, id_of, stage

KINDS = ("email", "ip", "card", "phone", "person")
BEFORE, AFTER, HIT = 48, 24, 64
ROUNDS, VOTES = 12, 3
BUCKETS, THRESHOLD, PSEUDO = 1 << 15, 0.9, 8.0

# Gazetteers, in the four languages of the corpora this was written for.
DOMAINS = "com org net edu gov info biz io de fr es uk us eu at ch it nl example".split()
CALLING = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 358 420 421".split()
FIRST_NAMES = (
    "Anna Anne Antonio Barbara Carlos Carmen Catherine Charles Christine Claudia Daniel David Elena Elizabeth Emma Eva François Hans "
    "Heinrich Isabelle James Jean Jennifer John José Joseph Juan Julia Karl Klaus Laura Linda Louis Lucía Luis Manuel Marc Maria Marie "
    "María Martin Mary Michael Miguel Monika Nicolas Patricia Paul Pedro Peter Philippe Pierre Richard Robert Sarah Sophie Susan "
    "Thomas Ursula William Wolfgang"
).split()
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Señor Señora Mme Monsieur Madame".split()
CUES = {
    "email": "e-?mail mail contact write address adresse correo courriel kontakt reply",
    "ip": "ip host server address gateway dns client login from adresse",
    "card": "card visa mastercard amex credit karte carte tarjeta kreditkarte payment",
    "phone": "phone tel telephone telefon teléfono téléphone call mobile cell fax handy contact whatsapp",
    "person": "name signed author contact dear patient employee mieter client",
}
FOES = "version ver build release isbn issn doi section chapter page figure table invoice order serial part sku article id ref"
PLACES = "street st avenue road university institute gmbh inc ltd hospital airport strasse straße rue calle school"

_LABEL, _DOT = "[A-Za-z0-9-]{1,63}+", r"\x20?[(\[{](?i:dot)[)\]}]\x20?|\x20(?i:dot)\x20"
_AT = r"\x20?[(\[{](?i:at)[)\]}]\x20?"
_LOCAL = "[A-Za-z0-9._%+-]"


class Form(NamedTuple):
    """A way in which candidates are written; ``guard`` is a cheap sign that a text may hold one."""

    kind: str
    pattern: str
    guard: Column | None = None


def forms(text: Column) -> list[Form]:
    """The base forms first, in the order of their kinds; they match what the contract's patterns match."""
    has = lambda mark: F.contains(text, F.lit(mark))
    return [
        Form("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", has("@")),
        Form("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+"),
        # A run of another number of digits fails its check anyway.
        Form("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"),
        Form("phone", r"\+[0-9][\x20().0-9-]+[0-9]", has("+")),
        Form("email", rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+(?:{_AT}{_LABEL}(?:(?:{_DOT}|\.){_LABEL})++|\x20(?i:at)\x20{_LABEL}(?:(?:{_DOT}){_LABEL})++)",
             text.rlike(r"(?i)[(\[{\x20](?:at|dot)[)\]}]|\x20dot\x20")),
        Form("ip", r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
                   r"|(?<![0-9.])[0-9]{1,3}(?:\x20?[\[(](?i:\.|dot)[\])]\x20?[0-9]{1,3}){3}(?![0-9])"),
        Form("card", r"(?<![0-9./_])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"),
        Form("phone", r"(?<![0-9A-Za-z+./_-])(?<![0-9][\x20)])(?:\([0-9]{2,5}\)\x20?|0[0-9]{1,4}[\x20/.-]|[0-9]{3}[\x20.-])[0-9]{3,4}"
                      r"(?:[\x20.-][0-9]{2,4}){1,3}+(?![0-9A-Za-z])"),
        Form("person", rf"(?<!\p{{L}})(?=\p{{Lu}})(?:(?:{'|'.join(TITLES)})\.?|{'|'.join(FIRST_NAMES)})(?:\x20\p{{Lu}}[\p{{L}}'-]{{1,30}}+){{1,3}}+"),
    ]


BASE_FORMS = 4


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    backward = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        x = F.substring(backward, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _passes(kind: str, hit: Column, base: bool) -> Column:
    """Whether a candidate passes the check of its kind."""
    if kind == "ip":
        part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        dotted = F.regexp_replace(hit, r"[^0-9]+", ".")
        return F.when(F.contains(hit, F.lit(":")), True).otherwise(dotted.rlike(rf"^{part}(?:\.{part}){{3}}$"))
    if kind == "card":
        return luhn(_digits(hit))
    if kind == "phone":
        return F.length(_digits(hit)).between(10 if base else 7, 15)
    return F.lit(True)


def candidates(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rid, d) of every row, and (rid, form, kind, start, end, ok, hit, before, after) of its candidates, written."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), doc_key(docs[id_col]).alias("d"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )
    every = forms(F.col("text"))
    for k, form in enumerate(every):
        guard = F.col("text").rlike(form.pattern) if form.guard is None else form.guard
        # Columns of their own, so that a text is split once and not for every match.
        rows = rows.withColumn(f"gaps{k}", F.when(guard, F.split("text", form.pattern, -1)))
        rows = rows.withColumn(f"hits{k}", F.when(F.size(f"gaps{k}") > 1, F.regexp_extract_all("text", F.lit(form.pattern), F.lit(0))))

    def found(k: int, form: Form) -> Column:
        def one(hit: Column, i: Column) -> Column:
            gap, after = F.get(f"gaps{k}", i), F.get(f"gaps{k}", i + 1)
            return F.struct(
                F.lit(k).alias("form"), i.alias("i"), F.length(gap).alias("gap"), F.length(hit).alias("size"),
                F.coalesce(_passes(form.kind, hit, k < BASE_FORMS), F.lit(False)).alias("ok"), F.substring(hit, 1, HIT).alias("hit"),
                F.substring(gap, -BEFORE, BEFORE).alias("before"), F.substring(after, 1, AFTER).alias("after"),
            )

        return F.coalesce(F.transform(f"hits{k}", one), F.array().cast(_HITS))

    hits = F.flatten(F.array(*[found(k, form) for k, form in enumerate(every)]))
    held = stage(rows.select("rid", "d", hits.alias("hits")), "personal-hits")
    each = held.select("rid", F.inline("hits"))
    upto = Window.partitionBy("rid", "form").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap").cast("bigint") + F.col("size")).over(upto)
    kind = F.element_at(F.array(*[F.lit(KINDS.index(f.kind)) for f in every]), F.col("form") + 1)
    spans = each.select("rid", "form", kind.alias("kind"), (end - F.col("size")).alias("start"), end.alias("end"), "ok", "hit", "before", "after")
    spans = spans.withColumn("base", F.col("ok") & (F.col("form") < BASE_FORMS))
    # The nearest base spans: the farthest end of those that begin no later, the next begin of those that begin later.
    along = Window.partitionBy("rid").orderBy("start", F.col("base").desc())
    reach = F.max(F.when(F.col("base"), F.col("end"))).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    following = F.min(F.when(F.col("base"), F.col("start"))).over(along.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    spans = spans.select("*", reach.alias("reach"), following.alias("following"))
    apart = (F.coalesce("reach", F.lit(0)) <= F.col("start")) & (F.coalesce("following", F.col("end")) >= F.col("end"))
    return held.select("rid", "d"), stage(spans.filter(F.col("base") | apart).drop("reach", "following"), "personal-spans")


_HITS = "array<struct<form:int,i:int,gap:int,size:int,ok:boolean,hit:string,before:string,after:string>>"


def _any_of(words: str | list[str]) -> str:
    return "|".join(words.split() if isinstance(words, str) else words)


def labelers() -> dict[str, Column]:
    """The votes: 1 for, 0 against, 2 none."""
    kind, hit, form = F.col("kind"), F.col("hit"), F.col("form")
    before, after = F.lower("before"), F.lower("after")
    digits = _digits(hit)
    is_kind = {k: kind == i for i, k in enumerate(KINDS)}
    cue = reduce(
        lambda e, k: e.when(is_kind[k] & before.rlike(rf"(?<!\p{{L}})(?:{_any_of(CUES[k])})(?!\p{{L}})[^\n]{{0,16}}$"), 1), KINDS[1:],
        F.when(is_kind["email"] & before.rlike(rf"(?<!\p{{L}})(?:{_any_of(CUES['email'])})(?!\p{{L}})[^\n]{{0,16}}$"), 1),
    )
    return {
        "pattern": F.when(form < BASE_FORMS, F.col("ok").cast("int")).otherwise(2),
        "spelling": F.when((form >= BASE_FORMS) & F.col("ok"), 1).when(form >= BASE_FORMS, 0).otherwise(2),
        "check": F.when(is_kind["card"] | is_kind["ip"], F.col("ok").cast("int")).when(is_kind["phone"], F.length(digits).between(7, 15).cast("int")).otherwise(2),
        "gazetteer": F.when(is_kind["email"], F.when(F.lower(hit).rlike(rf"(?:[.)\]}}\x20])(?:{_any_of(DOMAINS)})$"), 1).otherwise(2))
        .when(is_kind["phone"], F.when(hit.rlike(rf"^\+(?:{_any_of(CALLING)})(?![0-9])") | hit.rlike(r"^\(?0"), 1).otherwise(2))
        .when(is_kind["card"], digits.rlike("^(?:4|5[1-5]|2[2-7]|34|37|36|38|35|60|62|65)").cast("int"))
        .when(is_kind["ip"], F.when(hit.rlike(r"^0*(?:0|127|22[4-9]|2[3-5][0-9])\."), 0).otherwise(2))
        .when(is_kind["person"] & hit.rlike(rf"^(?:{_any_of(FIRST_NAMES)})\x20"), 1).otherwise(2),
        "cue": F.when(is_kind["person"] & hit.rlike(rf"^(?:{_any_of(TITLES)})\.?\x20"), 1).otherwise(F.coalesce(cue, F.lit(2))),
        "other": F.when(before.rlike(rf"(?<!\p{{L}})(?:{_any_of(FOES)})(?!\p{{L}})[^\p{{L}}\n]{{0,8}}$"), 0)
        .when(is_kind["person"] & after.rlike(rf"^[\x20,]{{0,2}}(?:{_any_of(PLACES)})(?!\p{{L}})"), 0).otherwise(2),
        "edges": F.when(before.rlike(r"[\p{L}0-9]$") | after.rlike(r"^[\p{L}0-9]"), 0).otherwise(2),
        "shape": F.when((F.length(digits) > 6) & digits.rlike(r"^([0-9])\1*$"), 0)
        .when(digits.rlike("^(?:0?123456789|987654321)"), 0)
        .when(is_kind["phone"] & hit.rlike(r"^(?:19|20)[0-9]{2}[./-]|[./-](?:19|20)[0-9]{2}$"), 0).otherwise(2),
    }


class Reliability(NamedTuple):
    """Log probability of each vote of each labeler by class (other, personal), and log odds by kind."""

    votes: dict[str, tuple[tuple[float, ...], tuple[float, ...]]]
    odds: tuple[float, ...]


def posterior(known: Reliability | None) -> Column:
    """Probability that a span with these votes is personal; without estimates, by majority."""
    names = list(labelers())
    if known is None:
        votes = reduce(Column.__add__, [F.when(F.col(n) == 1, 1.0).when(F.col(n) == 0, -1.0).otherwise(0.0) for n in names])
        return 1 / (1 + F.exp(-votes))
    ratio = [F.element_at(F.array(*[F.lit(p - o) for o, p in zip(*known.votes[n])]), F.col(n) + 1) for n in names]
    odds = F.element_at(F.array(*map(F.lit, known.odds)), F.col("kind") + 1)
    return 1 / (1 + F.exp(-reduce(Column.__add__, ratio, odds)))


def estimate(spans: DataFrame, rounds: int = ROUNDS) -> Reliability:
    """Expectation-maximisation over the counts of vote patterns.

    The prior counts say that a labeler is right more often than wrong, which also tells the two classes apart.
    """
    names = list(labelers())
    patterns = stage(spans.groupBy("kind", *names).agg(F.count(F.lit(1)).alias("n")), "vote-patterns")
    known = None
    for _ in range(rounds):
        p = patterns.select("kind", "n", *names, posterior(known).alias("p"))
        yes, no = F.col("n") * F.col("p"), F.col("n") * (1 - F.col("p"))
        sums = [
            F.coalesce(F.sum(F.when(F.col(name) == v, part)), F.lit(0.0)).alias(f"{name}{v}{c}")
            for name in names for v in range(VOTES) for c, part in enumerate((no, yes))
        ] + [F.coalesce(F.sum(F.when(F.col("kind") == k, part)), F.lit(0.0)).alias(f"kind{k}{c}") for k in range(len(KINDS)) for c, part in enumerate((no, yes))]
        got = p.agg(*sums).first()
        prior = ((4.0, 1.0, 4.0), (1.0, 4.0, 4.0))  # by class: against, for, none
        votes = {}
        for name in names:
            mass = [[got[f"{name}{v}{c}"] + prior[c][v] for v in range(VOTES)] for c in (0, 1)]
            votes[name] = tuple(tuple(math.log(m / sum(row)) for m in row) for row in mass)
        odds = tuple(math.log((got[f"kind{k}1"] + 1) / (got[f"kind{k}0"] + 1)) for k in range(len(KINDS)))
        known = Reliability(votes, odds)
    return known


def features() -> Column:
    """Hashed features of a span: its form, size and shape, and the words around it."""
    words_before = F.split(F.lower(F.trim(F.regexp_replace("before", r"[^\p{L}\p{N}]+", " "))), " ")
    first_after = F.element_at(F.split(F.lower(F.trim(F.regexp_replace("after", r"[^\p{L}\p{N}]+", " "))), " "), 1)
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("hit", r"\p{Lu}+", "A"), r"\p{Ll}+", "a"), "[0-9]", "9")
    of_kind = [
        F.concat_ws(" ", F.lit("form"), F.col("form"), F.col("ok")), F.concat_ws(" ", F.lit("shape"), "kind", shape),
        F.concat_ws(" ", F.lit("size"), "kind", F.least(F.length("hit"), F.lit(40))),
        F.concat_ws(" ", F.lit("word"), "kind", F.try_element_at(words_before, F.lit(-1))),
        F.concat_ws(" ", F.lit("word"), "kind", F.try_element_at(words_before, F.lit(-2))),
        F.concat_ws(" ", F.lit("next"), "kind", first_after),
    ]
    return F.array_distinct(F.array(*[F.pmod(F.xxhash64(f), F.lit(BUCKETS)).cast("int") for f in of_kind]))


def classified(spans: DataFrame, known: Reliability) -> DataFrame:
    """(rid, form, start, probability) of the candidates that are no base spans, by naive Bayes on the posteriors."""
    soft = spans.select("rid", "form", "start", "base", posterior(known).alias("p"), F.explode(features()).alias("f"))
    # Every span has one feature of its form; the totals of the classes are those of the spans.
    total = spans.select(posterior(known).alias("p")).agg(F.coalesce(F.sum("p"), F.lit(0.0)), F.count(F.lit(1))).first()
    share = (total[0] + 1) / (total[1] + 2)
    sums = stage(soft.groupBy("f").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")), "feature-sums")
    odds = math.log(share / (1 - share))
    weight = F.log((F.col("yes") + PSEUDO * share) / (F.col("no") + PSEUDO * (1 - share))) - odds
    weighed = soft.filter("not base").join(F.broadcast(sums.select("f", weight.alias("w"))), "f")
    return weighed.groupBy("rid", "form", "start").agg((1 / (1 + F.exp(-(F.sum("w") + odds)))).alias("probability"))


def _written(spans: Column) -> Column:
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ",")


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(rid, d) of every row, and (rid, kind, start, end, base) of its spans."""
    rows, spans = candidates(docs, id_col, text_col)
    voted = stage(spans.select("*", *[vote.alias(name) for name, vote in labelers().items()]), "personal-votes")
    added = classified(voted, estimate(voted)).filter(F.col("probability") >= threshold)
    more = voted.filter("ok and not base").join(added, ["rid", "form", "start"], "left_semi")
    columns = ["rid", "kind", "start", "end"]
    # Two forms may give one span.
    return rows, voted.filter("base").select(*columns, F.lit(True).alias("base")).unionByName(more.select(*columns, F.lit(False).alias("base")).distinct())


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    rows, spans = personal_spans(docs, id_col, text_col, threshold)
    of_row = spans.groupBy("rid").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end", "base"))).alias("every"),
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{KINDS[k]}") for k in range(BASE_FORMS)],
    )
    base = F.filter("every", lambda s: s["base"])
    written = of_row.select("rid", *[f"n_{k}" for k in KINDS[:BASE_FORMS]], _written(base).alias("base"), _written(F.col("every")).alias("spans"))
    return rows.join(written, "rid", "left").select(
        id_of(F.col("d")).alias("doc_id"), *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KINDS[:BASE_FORMS]],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )
