"""Personal data by bootstrapped contextual extraction.

Four base kinds are found by fixed forms (email, ip, card, phone); they are the
seeds. Every seed, every other identifier-like token (four digits or an @) and
every other number of 7 to 19 digits that is written over several words or glued
to a word is an instance. Its patterns are its neighbouring words together with
its shape, and with its coarse class (address, dotted quad, 7 to 19 digits and
separators) where it has one; by the second a context finds values of shapes
that no seed has, such as a national phone number. Other tokens are found by
shape only: years and short codes would else pass with the values beside them.
Spark scores the pattern-instance graph in rounds: a pattern's
confidence for a kind is the confidence mass of its known instances of that kind
over all its distinct instances (unknown ones count against it), an unknown
instance's is the noisy-or over contexts of its most confident patterns. A token
inside a longer number does not count against a pattern, and of added spans
within one another the longest stays. What passes joins the known
instances of the next round, and its occurrences are added as spans of the kind.
The rounds end when nothing new passes.

The text is read once; base spans and instances go to the shared folder, the
graph has only rows for identifier-like tokens, and both sides of it are
aggregated by key with map-side combining.

Nulls: a null text is empty. Null ids and repeated rows each give a result row.
Only the named columns are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from functools import cache
from hashlib import blake2b

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, shared

KINDS = ("email", "ip", "card", "phone")
#: Distinct known instances that a pattern needs, and the confidences asked for.
MIN_SUPPORT = 3
PATTERN_CONFIDENCE = 0.8
INSTANCE_CONFIDENCE = 0.95
#: Rounds after which an error is raised; each adds instances, so they end by themselves.
ROUNDS = 200
#: Longer context words, shapes and values are replaced by their hash in the graph; of what is glued to a value, its
#: last so many characters are a context word.
WORD_CHARS, VALUE_CHARS = 32, 256

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_TOKEN = re.compile(r"\S+")
_EDGE = ".,;:!?()[]{}<>\"'"
_QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
#: Numbers of a line with single separators between them; a number may be glued to a word before it.
_RUN = re.compile(r"(?<!\w)(?<![0-9][./+@-])[+(]?[0-9][0-9().+/-]*+"
                  r"(?:[^\S\r\n]++(?:[-–/][^\S\r\n]++)?[+(]?[0-9][0-9().+/-]*+)*+")
_NOT_NUMBER = re.compile(r"[^0-9\s().+/–-]")
_GLUE = re.compile(r"[:=<>(\[{\"',;|]")
#: Digits of the base kinds that are numbers, from a phone number without its prefix to a card.
LEAST_DIGITS, MOST_DIGITS = 7, 19


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, in order; leftmost, non-overlapping within a kind.

    An address is found from its ``@``: no other character of it can be one, so
    the text is walked once however long its runs are. A run of digits is
    entered only at its start, which gives the same matches.
    """
    out = []
    at, taken = text.find("@"), 0
    while at >= 0:
        begin = taken + len(text[taken:at].rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            out.append((begin, 0, m.end()))
        taken = m.end() if m else at + 1
        at = text.find("@", taken)
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return sorted(out)


def key(value: str, chars: int) -> str:
    """The value, or a hash of the whole of it if it is longer than ``chars``."""
    return value if len(value) <= chars else f"#{blake2b(value.encode(), digest_size=16).hexdigest()}"


def shape(value: str) -> str:
    """Character classes of a value: runs of digits with their length, runs of letters without."""
    return key(re.sub("[0-9]+", lambda m: f"9{{{min(len(m[0]), 20)}}}", re.sub(r"[^\W\d_]+", "a", value)), WORD_CHARS)


def coarse(value: str) -> str:
    """Coarse class of a value; empty if no seed has its class."""
    if "@" in value:
        return "@"
    if _QUAD.fullmatch(value):
        return "quad"
    number = not _NOT_NUMBER.search(value) and LEAST_DIGITS <= len(_DIGIT.findall(value)) <= MOST_DIGITS
    return "digits" if number else ""


def _trimmed(text: str, b: int, e: int) -> tuple[int, int]:
    """Without separators at the end and brackets that have no partner."""
    e = b + len(text[b:e].rstrip("./+-("))
    value = text[b:e]
    more = value.count(")") - value.count("(")
    if more > 0:
        e = b + len(value[:len(value) - min(more, len(value) - len(value.rstrip(")")))].rstrip("./+-("))
    elif more < 0 and value[0] == "(":
        b += 1
    return b, e


def numbers(text: str, seeds: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of numbers of one or more words outside the ``seeds`` (start, end, kind; in order).

    Of a row of numbers with more digits than a kind can have, the longest
    beginning and the longest end that are short enough are proposed: only
    these have words beside them.
    """
    out, k = [], 0
    for m in _RUN.finditer(text):
        words = [(t.start(), t.end()) for t in _TOKEN.finditer(text, m.start(), m.end())]
        if m.end() < len(text) and (text[m.end()].isalnum() or text[m.end()] in "_@"):
            words.pop()
        group: list[tuple[int, int, int]] = []
        depth = 0
        for s, e in words + [(m.end(), m.end())]:
            while k < len(seeds) and seeds[k][1] <= s:
                k += 1
            if s < e and not (k < len(seeds) and seeds[k][0] < e):
                group.append((s, e, len(_DIGIT.findall(text, s, e))))
                depth += text.count("(", s, e) - text.count(")", s, e)
                if depth >= 0 and text[e - 1] != ".":   # no bracket or sentence ends here
                    continue
            for side in (group, group[::-1]):
                ends, total = [], 0
                for x in side:
                    total += x[2]
                    if total > MOST_DIGITS:
                        break
                    ends.append(x)
                if sum(x[2] for x in ends) >= LEAST_DIGITS:
                    out.append(_trimmed(text, min(x[0] for x in ends), max(x[1] for x in ends)))
                if len(ends) == len(group):
                    break
            group, depth = [], 0
    return out


def instances(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int | None, bool, str, list[str]]]:
    """(start, end, seed kind or None, not inside a longer number, value, patterns) of seeds and identifier-like spans.

    A pattern is a context and a form, separated by a tab.
    """
    if not spans and "@" not in text and not _DIGIT.search(text):
        return []
    words = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    found, k, covered = [], 0, 0
    ordered = sorted((s, e, kind) for s, kind, e in spans)
    starts = [s for s, _ in words]
    runs = {(b, f): (bisect_right(starts, b) - 1, bisect_left(starts, f)) for b, f in numbers(text, ordered)}
    inside = {j for i, right in runs.values() for j in range(i, right)}
    for i, (s, e) in enumerate(words):
        while k < len(ordered) and ordered[k][0] < e:   # seeds that begin in this word
            b, covered_to, kind = ordered[k]
            right = next((j for j in range(i, len(words)) if words[j][0] >= covered_to), len(words))
            found.append((b, covered_to, kind, True, i, right))
            covered = max(covered, covered_to)
            k += 1
        token = text[s:e]
        b = s + len(token) - len(token.lstrip(_EDGE))
        f = e - len(token) + len(token.rstrip(_EDGE))
        if b >= covered and b < f and ("@" in token or len(_DIGIT.findall(token)) >= 4):
            if (b, f) not in runs:
                found.append((b, f, None, i not in inside, i, i + 1))
            glue = [m.end() for m in _GLUE.finditer(text, b, max(b, text.rfind("@", b, f)))][-1:]
            found += [(x, f, None, True, i, i + 1) for x in glue if text[x] != "@"]
    found += [(b, f, None, True, i, right) for (b, f), (i, right) in runs.items()]

    @cache
    def word(j: int) -> str:
        return key(text[words[j][0]:words[j][1]].strip(_EDGE).lower(), WORD_CHARS) if 0 <= j < len(words) else ""

    out = []
    for b, e, kind, main, i, right in found:
        value = text[b:e]
        left = text[max(words[i][0], b - WORD_CHARS):b].lower()[-WORD_CHARS:]   # what is glued to the value, as in ``key=value``
        near, form = f"{word(i - 1)} {left}", shape(value)
        around = [f"1 {near}", f"2 {word(i - 2)} {near}", f"3 {near} {word(right)}"]
        patterns = [f"{c}\t{form}" for c in around]
        if group := coarse(value):
            after = f"4 {word(right)} {word(right + 1)}"
            patterns += [f"{c}\t<{group}>" for c in (*around, after) if c[1:].strip()]
        out.append((b, e, kind, main, key(value, VALUE_CHARS), patterns))
    return out


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One pass over whole texts, written to the shared folder: ``row, doc_id, text_hash, base, found``."""
    id_type = dict(docs.dtypes)[id_col]

    def run(doc, key, text):
        base, found = [], []
        for t in text.to_pylist():
            spans = base_spans(t or "")
            base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
            found.append([{"start": s, "end": e, "kind": k, "main": m, "value": v, "patterns": p}
                          for s, e, k, m, v, p in instances(t or "", spans)])
        return {"doc_id": doc, "text_hash": key, "base": base, "found": found}

    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                      F.col(text_col).alias("text"))
    out = map_rows(src, run, f"doc_id {id_type}, text_hash long, base array<struct<start:int,kind:int,end:int>>, "
                   "found array<struct<start:int,end:int,kind:int,main:boolean,value:string,patterns:array<string>>>")
    return shared(out.withColumn("row", F.monotonically_increasing_id()))


def bootstrap(extracted: DataFrame, rounds: int = ROUNDS, support: int = MIN_SUPPORT,
              pattern_confidence: float = PATTERN_CONFIDENCE,
              instance_confidence: float = INSTANCE_CONFIDENCE) -> DataFrame:
    """``value, kind, confidence`` of the instances that patterns discovered (no seeds)."""
    each = extracted.select(F.explode("found").alias("f")).select("f.value", "f.kind", "f.main", "f.patterns")
    graph = shared(each.select("value", "main", F.explode("patterns").alias("pattern"))
                   .groupBy("value", "pattern").agg(F.max("main").alias("main")))
    known = shared(each.where("kind is not null").groupBy("value").agg(F.min("kind").alias("kind"))
                   .withColumn("confidence", F.lit(1.0)).withColumn("seed", F.lit(True)))
    for _ in range(rounds):
        state = graph.join(known, "value", "left")
        mass = [F.sum(F.when(F.col("kind") == k, F.col("confidence")).otherwise(0.0)) for k in range(len(KINDS))]
        counts = [F.count(F.when(F.col("kind") == k, 1)) for k in range(len(KINDS))]
        best = F.greatest(*[F.struct(m.alias("mass"), n.alias("n"), F.lit(-k).alias("k"))
                            for k, (m, n) in enumerate(zip(mass, counts))])
        good = (state.groupBy("pattern").agg(best.alias("b"), F.count(F.when(F.col("kind").isNotNull() | F.col("main"), 1)).alias("total"))
                .where((F.col("b.n") >= support) & (F.col("b.mass") >= pattern_confidence * F.col("total")))
                .select("pattern", (-F.col("b.k")).alias("kind"), (F.col("b.mass") / F.col("total")).alias("p")))
        new = (graph.join(known, "value", "left_anti").join(good, "pattern")
               .groupBy("value", "kind", F.substring_index("pattern", "\t", 1).alias("context")).agg(F.max("p").alias("p"))
               .groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("p"), F.lit(1e-9)))))).alias("c"))
               .groupBy("value").agg(F.max(F.struct("c", (-F.col("kind")).alias("k"))).alias("x"))
               .where(F.col("x.c") >= instance_confidence)
               .select("value", (-F.col("x.k")).alias("kind"), F.col("x.c").alias("confidence"),
                       F.lit(False).alias("seed")))
        new = shared(new)
        if new.isEmpty():
            break
        known = known.unionByName(new)
    else:
        raise RuntimeError("the bootstrap did not settle")
    return known.where("not seed").drop("seed")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, text_hash, base, spans`` (arrays of start, kind, end in order); ``spans`` holds the base spans
    and those that the method adds."""
    extracted = extract(docs, id_col, text_col)
    learned = bootstrap(extracted, **options).select("value", F.col("kind").alias("new_kind"))
    earlier = Window.partitionBy("row").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    added = (extracted.select("row", F.explode("found").alias("f")).where("f.kind is null")
             .select("row", "f.start", "f.end", "f.value").join(learned, "value")
             .withColumn("before", F.max("end").over(earlier)).where("before is null or before < end")
             .groupBy("row").agg(F.collect_list(F.struct("start", F.col("new_kind").cast("int").alias("kind"), "end"))
                                 .alias("added")))
    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")
    return (extracted.select("row", "doc_id", "text_hash", "base").join(added, "row", "left")
            .select("doc_id", "text_hash", "base",
                    F.array_sort(F.concat("base", F.coalesce("added", none))).alias("spans")))


def span_text(spans) -> F.Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every span in the text replaced by ``<kind>``; overlapping spans become one."""
    found = find(docs, id_col, text_col, **options)
    hits = (found.where(F.size("spans") > 0).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"),
                                                    F.col("spans").alias("_spans")).dropDuplicates(["_id", "_hash"]))
    joined = docs.join(hits, docs[id_col].eqNullSafe(hits["_id"]) & (F.xxhash64(docs[text_col]) == hits["_hash"]), "left")
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    text, spans = docs[text_col], hits["_spans"]
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc, x):
        inside = x["start"] < acc["at"]
        gap = F.substring(text, acc["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0)))
        return F.struct(F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], gap, F.get(names, x["kind"]))).alias("out"),
                        F.greatest(acc["at"], x["end"]).alias("at"))

    clean = F.aggregate(spans, start, step,
                        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return joined.select(*[F.when(spans.isNull(), text).otherwise(clean).alias(c) if c == text_col
                           else docs[c] for c in docs.columns])
