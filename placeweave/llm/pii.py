"""Personal data: generators propose spans, boosted trees choose among them. DataFrame functions only.

Base spans come from four exact patterns and their tests. Wider patterns propose further candidates,
which may overlap. Weak labels tell which of them are personal data by rules that need no base match:
an address once (at) and (dot) are read as signs, a number with a check digit, a number after a
telephone word. What these rules look at is kept from the gradient-boosted trees, which see format
and context only and so find the same forms where no rule speaks. A span is added if it meets no
base span and its score passes its kind's threshold: calibrated on candidates outside base spans, in
the half of the texts that the trees haven't seen. Trees and thresholds come from all candidates of all texts;
equal ones are counted before they are shuffled. The trees become a column expression.

Patterns run over marked copies of a text, in which a separator between two digits (or a dot
between two parts of a host name) is one special character. So a repeated group is a plain run of
characters, and each pattern takes time linear in the text and no stack, however long a run is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.llm.common import written

KINDS = ("email", "ip", "card", "phone")
#: Number, depth and step of the trees.
TREES, DEPTH, STEP = 10, 3, 0.3
#: Of the candidates outside base spans that pass a threshold, this share must have a label, and there must be so many.
PRECISION, LEAST = 0.98, 20
SPAN = "array<struct<kind:string,start:int,end:int>>"

_MARK = "\\x01"
_DOT = r"\.(?<=[A-Za-z0-9-]\.)(?=[A-Za-z0-9-])"
_GAP = r"[\x20-](?<=[0-9][\x20-])(?=[0-9])"
_LOCAL = rf"A-Za-z0-9._%+{_MARK}-"
# what has to be in a text (holds wherever the pattern does), the pattern over its marked copy, which copy
BASE = {
    "email": ("@", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++{_MARK}[A-Za-z0-9{_MARK}-]++", _DOT),
    "ip": (r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", None),
    "card": (r"[0-9](?:[\x20-]?[0-9]){15}", rf"[0-9][0-9{_MARK}]{{15,}}+", _GAP),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", None),
}
PROPOSED = {
    "email": (r"@|[(\[]at[)\]]", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}+){1,8}"),
    "ip": (r"[0-9][.,][0-9]", r"(?<![0-9])[0-9]{1,3}+(?:[.,][0-9]{1,3}+){3}"),
    "card": (r"[0-9][0-9\x20-]{11,30}[0-9]", r"(?<![0-9])[0-9][0-9\x20-]{11,30}[0-9]"),
    "phone": (r"[0-9][0-9\x20().-]{5,20}[0-9]", r"[+(]?[0-9][0-9\x20().-]{5,20}[0-9]"),
}
# Words that make the number right after them personal data; for labels only.
WORDS_BEFORE = {
    "phone": r"\b(?:tele?(?:fon|phone)?|phone|call|fax|mobile?|cell|whatsapp)\b",
    "card": r"\b(?:card|carte|karte|tarjeta|visa|mastercard|amex|credit)\b",
    "ip": r"\b(?:ip|host|server|addr(?:ess)?)\b",
}


def no_spans() -> Column:
    return F.array().cast(SPAN)


def _places(marked: Column, pattern: str) -> Column:
    """start, end (code points, end exclusive) and what was found, for every match."""
    pairs = F.zip_with(F.split(marked, pattern, -1), F.regexp_extract_all(marked, F.lit(pattern), F.lit(0)), lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))
    kind = "struct<at:int,found:array<struct<start:int,end:int,hit:string>>>"
    begin = F.struct(F.lit(0).alias("at"), F.array().alias("found")).cast(kind)

    def add(done: Column, x: Column) -> Column:
        start = done.at + x.gap
        end = start + F.length(x.hit)
        return F.struct(end.alias("at"), F.concat(done.found, F.array(F.struct(start.alias("start"), end.alias("end"), x.hit.alias("hit")))).alias("found")).cast(kind)

    return F.aggregate(F.filter(pairs, lambda x: x.hit.isNotNull()), begin, add, lambda done: done.found)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda t, i: add(t, i).cast("int")) % 10 == 0


def _sound(kind: str, hit: Column) -> Column:
    digits = _digits(hit)
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.right(p, F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _kept(kind: str, found: Column) -> Column:
    return F.filter(found, lambda x: _sound(kind, x.hit))


def _of(kind: str, spans: Column | str) -> Column:
    return F.filter(spans, lambda s: s.kind == kind)


def _spans(kind: str, found: Column) -> Column:
    return F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x.start.alias("start"), x.end.alias("end")))


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of each kind, by start."""
    plain = F.translate(text, "\x01", "\x02")
    out = {}
    for kind, (needs, pattern, mark) in BASE.items():
        there = F.contains(text, F.lit(needs)) if needs == "@" else text.rlike(needs)
        marked = F.regexp_replace(plain, mark, "\x01") if mark else plain
        found = _kept(kind, _places(marked, pattern))
        out[kind] = F.when(there, _spans(kind, found)).otherwise(no_spans())
    return out


FEATURES = ("kind", "length", "digits", "letters", "other", "words", "dots", "hyphens", "spaces", "brackets", "groups", "same_digit", "before", "after", "digits_near")


def _features(k: int, text: Column, x: Column) -> Column:
    hit, digits = x.hit, _digits(x.hit)
    before, after = _before(text, x), F.substring(text, x.end + 1, F.lit(10))
    count = lambda pattern: F.length(F.regexp_replace(hit, pattern, ""))
    kind_of = lambda c: F.when(c == "", 0).when(c.rlike("[0-9]"), 1).when(c.rlike("[A-Za-z]"), 2).when(c.rlike(r"\s"), 3).otherwise(4)
    values = [
        F.lit(k), F.length(hit), F.length(digits), count("[^A-Za-z]"), count(r"[A-Za-z0-9\x20]"), F.size(F.split(hit, r"\x20")),
        count(r"[^.]"), count("[^-]"), count(r"[^\x20]"), count(r"[^()\[\]]"), F.size(F.split(hit, "[^0-9]+")),
        F.length(F.regexp_replace(digits, r"(.)(?=.*\1)", "")), kind_of(F.right(before, F.lit(1))), kind_of(F.left(after, F.lit(1))),
        F.length(_digits(before)) + F.length(_digits(after)),
    ]
    return F.struct(*(v.cast("double").alias(name) for name, v in zip(FEATURES, values)))


def _before(text: Column, x: Column) -> Column:
    return F.substring(text, F.greatest(x.start - 29, F.lit(1)), F.least(x.start, F.lit(30)))


def _label(kind: str, text: Column, x: Column) -> Column:
    """Whether rules of its own, not the base pattern, take the candidate for personal data."""
    hit, digits = x.hit, _digits(x.hit)
    if kind == "email":
        address = F.regexp_replace(hit, r"\x20?(?:@|\(at\)|\[at\])\x20?", "@")
        address = F.regexp_replace(address, r"\x20?(?:\.|\(dot\)|\[dot\])\x20?", ".")
        return address.rlike(r"^[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}$")
    said = F.lower(_before(text, x)).rlike(WORDS_BEFORE[kind] + r"[^0-9]{0,12}$")
    if kind == "ip":
        small = F.forall(F.split(hit, "[.,]"), lambda p: F.coalesce(p.try_cast("int"), F.lit(999)) <= 255)
        return small & (~F.contains(hit, F.lit(",")) | said)
    if kind == "card":
        sound = F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
        return sound & ((F.length(digits) >= 16) | said)
    return F.length(digits).between(7, 15) & (hit.startswith("+") | said)


def _meets(x: Column, spans: Column) -> Column:
    return F.exists(spans, lambda s: (s.start < x.end) & (x.start < s.end))


def _proposed(k: int, kind: str, text: Column, base: Column, pattern: str, labelled: bool) -> Column:
    def one(x: Column) -> Column:
        label = [_label(kind, text, x).alias("label")] if labelled else []
        return F.struct(F.lit(kind).alias("kind"), x.start.alias("start"), x.end.alias("end"), _features(k, text, x).alias("f"), _meets(x, base).alias("taken"), *label)

    return F.transform(_places(text, pattern), one)


def candidates(text: Column, base: Column, labelled: bool = False) -> Column:
    """Proposed spans with their features and whether they meet a base span; for fitting, with labels."""
    out = []
    for k, (kind, (needs, pattern)) in enumerate(PROPOSED.items()):
        found = _proposed(k, kind, text, base, pattern, labelled)
        out.append(F.when(text.rlike(needs), found))  # null where there is nothing to look for
    return F.flatten(F.array_compact(F.array(*out)))


def _tree(node, f: Column) -> Column:
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(f[FEATURES[split.featureIndex()]] <= float(split.threshold()), _tree(node.leftChild(), f)).otherwise(_tree(node.rightChild(), f))


class Chooser:
    """Boosted trees and a threshold for each kind; fitted to candidates (kind, f, label, taken, fold) and how often each occurs (n)."""

    def __init__(self, counted: DataFrame):
        from pyspark.ml.classification import GBTClassifier
        from pyspark.ml.feature import VectorAssembler

        self.trees, self.threshold = [], {}
        rows = counted.select("kind", "fold", "taken", F.col("label").cast("double").alias("label"), "f", "n")
        flat = rows.select("fold", "label", F.col("n").cast("double").alias("n"), *(F.col(f"f.{c}").alias(c) for c in FEATURES))
        fit = flat.where("fold = 0")
        if fit.select("label").distinct().count() < 2:
            return
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7, weightCol="n").fit(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(fit))
        self.trees = [(w, t._java_obj.rootNode()) for w, t in zip(model.treeWeights, model.trees)]
        scored = rows.where("fold = 1 AND NOT taken").select("kind", "label", "n", F.round(self.score(F.col("f")), 3).alias("p"))
        found: dict[str, list] = {}
        for r in scored.groupBy("kind", "p").agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n")).orderBy("kind", F.desc("p")).collect():  # at most 1,001 a kind
            found.setdefault(r.kind, []).append((r.p, r.good, r.n))
        for kind, steps in found.items():
            good = n = 0
            for p, g, m in steps:
                good, n = good + g, n + m
                if p >= 0.5 and n >= LEAST and good >= PRECISION * n:
                    self.threshold[kind] = p

    def score(self, f: Column) -> Column:
        margin = reduce(lambda a, b: a + b, (F.lit(float(w)) * _tree(root, f) for w, root in self.trees))
        return 1 / (1 + F.exp(-2 * margin))

    def chosen(self, found: Column) -> Column:
        """Candidates that pass and meet no base span."""
        if not self.threshold:
            return no_spans()

        def passes(x: Column) -> Column:
            enough = F.lit(2.0)
            for kind, p in self.threshold.items():
                enough = F.when(x.kind == kind, F.lit(p)).otherwise(enough)
            return ~x.taken & (F.round(self.score(x.f), 3) >= enough)

        return F.transform(F.filter(found, passes), lambda x: F.struct(x.kind.alias("kind"), x.start.alias("start"), x.end.alias("end")))


def _with_base(docs: DataFrame, text: str) -> DataFrame:
    rows = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    return rows.withColumn("_base", F.concat(*base_spans(F.col("_text")).values()))


def fit(docs: DataFrame, text: str = "text") -> Chooser:
    rows = _with_base(docs.select(F.col(text).alias("text")), "text")
    found = rows.select(F.pmod(F.xxhash64("text"), F.lit(2)).alias("fold"), F.inline(candidates(F.col("_text"), F.col("_base"), labelled=True)))
    counted = found.groupBy("kind", "fold", "label", "taken", "f").agg(F.count("*").alias("n"))
    return Chooser(written(counted, "candidates"))


def _order(spans: Column) -> Column:
    """By kind as listed, then start."""
    return F.flatten(F.array(*(F.array_sort(_of(kind, spans)) for kind in KINDS)))


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))))


def with_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with ``_text`` (null as empty), ``_base`` and ``_spans``: base spans, and with the added ones."""
    chooser = fit(docs, text)
    rows = _with_base(docs, text)
    if not chooser.threshold:
        return rows.withColumn("_spans", F.col("_base"))
    return rows.withColumn("_spans", _order(F.concat("_base", chooser.chosen(candidates(F.col("_text"), F.col("_base"))))))


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (with the added ones).

    Null texts are empty; null keys and repeated rows come out as they are; of an empty table nothing
    does, and without candidates of both sorts nothing is added to the base.
    """
    rows = with_spans(docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text)), key, text)
    count = [F.size(_of(kind, "_base")).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return rows.select(key, *count, F.sha2(_listed(F.col("_base")).cast("binary"), 256).alias("base_sha256"), _listed(F.col("_spans")).alias("spans"))


def redacted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with every span of ``text`` replaced by its kind in brackets; spans that overlap, by the first's."""
    spans = F.array_sort(F.transform("_spans", lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind"))))
    state = "struct<at:int,out:array<string>>"

    def add(done: Column, s: Column) -> Column:
        more = F.array(F.substring(F.col("_text"), done.at + 1, s.start - done.at), F.concat(F.lit("["), F.upper(s.kind), F.lit("]")))
        out = F.when(s.start >= done.at, F.concat(done.out, more)).otherwise(done.out)
        return F.struct(F.greatest(done.at, s.end).alias("at"), out.alias("out")).cast(state)

    def end(done: Column) -> Column:
        return F.concat(F.array_join(done.out, ""), F.substring(F.col("_text"), done.at + 1, F.length("_text")))

    rows = with_spans(docs, key, text).withColumn("_sorted", spans)
    new = F.when(F.size("_sorted") > 0, F.aggregate("_sorted", F.struct(F.lit(0).alias("at"), F.array().alias("out")).cast(state), add, end)).otherwise(F.col(text))
    return rows.withColumn(text, new).select(*docs.columns)
