"""Secret scans in DataFrame expressions only: patterns, and entropy of sliding windows.

Base kinds ``assign access hex`` are leftmost non-overlapping pattern matches; their
positions come from splitting the text at the matches.  The method adds ``entropy_hex``
and ``entropy_base64``: candidate strings are cut into runs of one character class, and
the Shannon entropy of every window of a run is kept by incremental counts (one
character enters, one leaves, and only their two terms of the sum change).  Hex runs count
without regard to case.  A base64 run is judged by its parts between ``- _ / + =``:
words, camel-case names, numbers and UUIDs are left out, and what remains must hold a
part of ``CORE`` characters and reach the threshold of its class (mixed case, or one case
as in base32 and base36).  So slugs and paths are no spans, but a prefixed token, a key
without capitals or base64 with slashes is.  A few placeholder words suppress their run.
Base spans are never suppressed.

One projection over the text column: no shuffle, no Python.  Edge cases: a null or
empty text has no spans; ties and repeated rows each get their own row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

_VALUE = "[A-Za-z0-9+/_.=-]+"
_ASSIGN = "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
#: Of a run of the class, all is one match; so the least length can stand in the pattern.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
ASSIGN = _ASSIGN + _VALUE

#: kind, candidate run, alphabet, window, least entropy in bits.
CLASSES = (("entropy_hex", "[0-9a-fA-F]{24,}", "0123456789abcdef", 24, 3.0),
           ("entropy_base64", "[A-Za-z0-9+/_=-]{20,}",
            "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 20, 3.9))
#: Least entropy of base64 runs that remain in one case: 20 random letters and digits of one
#: case reach 3.9 only in half of all draws, and 3.3 in 99 of 100.
ONE_CASE = 3.3
CORE = 6
UUID = "(?<![0-9a-fA-F])[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}(?![0-9a-fA-F])"
_SEPARATOR = "[-_/+=]"
#: Words, camel-case names and capitals, with numbers before and after them; numbers inside
#: only in short parts.  Six consonants in a row are no word.
_HUMPS = "(?:[a-z]?(?:[A-Z]{0,4}[a-z]{2,}+)++[A-Z]{0,4}|[A-Z]++)"
_WORD = f"^[0-9]*+(?:{_HUMPS}[0-9]*+)?$"
_NAME = f"^(?=.{{1,16}}$)[0-9]*+{_HUMPS}[0-9]++{_HUMPS}[0-9]*+$"
_NO_WORD = "(?i)[b-df-hj-np-tv-xz]{6}"
PLACEHOLDERS = "(?i)example|placeholder|changeme|dummy|xxxx|0123456789|abcdefgh"


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<start, text>> of all matches: between two matches lies one piece."""
    none = F.array().cast("array<struct<start:int,text:string>>")

    def place(pieces: Column, found: Column) -> Column:
        sizes = F.transform(found, lambda x, i: F.length(F.get(pieces, i)) + F.length(x))
        ends = F.aggregate(sizes, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                           lambda s, n: F.struct((s["at"] + n).alias("at"),
                                                 F.concat(s["out"], F.array(s["at"] + n)).alias("out")),
                           lambda s: s["out"])
        return bind(ends, lambda e: F.transform(found, lambda x, i: F.struct(
            (F.get(e, i) - F.length(x)).alias("start"), x.alias("text"))))

    both = F.struct(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    return F.when(text.rlike(pattern), bind(both, lambda b: place(b["p"], b["m"]))).otherwise(none)


def _spans(found: Column, kind: str, rank: int) -> Column:
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(rank).alias("rank"),
        (m["start"] + F.length(m["text"])).alias("end"), F.lit(kind).alias("kind")))


def best_window_entropy(run: Column, alphabet: str, window: int) -> Column:
    """The largest entropy (bits) of any ``window`` successive characters of ``run``.

    State: the count of each symbol in the window and S = sum of c*log2(c); the entropy is
    log2(w) - S/w.  A step adds one symbol, drops one, and updates S by the two terms.
    """
    codes = F.transform(F.sequence(F.lit(1), F.length(run)),
                        lambda i: F.instr(F.lit(alphabet), F.substring(run, i, F.lit(1))) - 1)
    xlogx = F.array(*[F.lit(c * math.log2(c) if c > 1 else 0.0) for c in range(window + 2)])
    zero = F.array_repeat(F.lit(0), len(alphabet))
    start = F.struct(zero.alias("n"), F.lit(0.0).alias("s"), F.lit(float(window * 64)).alias("least"))

    def bump(counts: Column, code: Column, by: int) -> Column:
        return F.transform(counts, lambda n, k: F.when(k == code, n + by).otherwise(n))

    def walk(seq: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            come, go = F.get(seq, i), F.get(seq, i - window)
            had = F.get(state["n"], come)
            added = state["s"] + F.get(xlogx, had + 1) - F.get(xlogx, had)
            mid = F.struct(bump(state["n"], come, 1).alias("n"), added.alias("s"), state["least"].alias("least"))

            def leave(m: Column) -> Column:
                old = F.get(m["n"], go)
                after = m["s"] - F.get(xlogx, old) + F.get(xlogx, old - 1)
                return F.struct(bump(m["n"], go, -1).alias("n"), after.alias("s"), F.least(m["least"], after).alias("least"))

            def full(m: Column) -> Column:
                return F.struct(m["n"].alias("n"), m["s"].alias("s"),
                                F.when(i == window - 1, m["s"]).otherwise(m["least"]).alias("least"))

            return bind(mid, lambda m: F.when(i >= window, leave(m)).otherwise(full(m)))

        return F.aggregate(F.sequence(F.lit(0), F.size(seq) - 1), start, step, lambda s: s["least"])

    return F.log2(F.lit(float(window))) - bind(codes, walk) / window


def ordinary(part: Column) -> Column:
    """Whether a part of a run is a word, a name or a number."""
    return (part.rlike(_WORD) | part.rlike(_NAME)) & ~part.rlike(_NO_WORD)


def _remains(run: Column) -> Column:
    """What of a base64 run may be random, as candidates: the run without UUIDs and ordinary
    parts, and the run with them if they are the lesser part of it."""
    def pick(parts: Column, whole: Column) -> Column:
        unknown = F.filter(parts, lambda p: ~ordinary(p))
        core = F.exists(unknown, lambda p: F.length(p) >= CORE)
        kept = F.filter(parts, lambda p: (p != "") & ~(ordinary(p) & (F.length(p) >= 3)))
        most = 2 * F.length(F.array_join(unknown, "-")) >= F.length(whole)
        return F.when(~core, F.array().cast("array<string>")).otherwise(F.array_distinct(
            F.when(most, F.array(whole, F.array_join(kept, "-"))).otherwise(F.array(F.array_join(kept, "-")))))

    cut = F.regexp_replace(run, UUID, "-")
    return bind(cut, lambda c: bind(F.split(c, _SEPARATOR, -1), lambda parts: pick(parts, c)))


def _of(kind: str):
    return lambda span: span["kind"] == kind


def _random(kind: str, pattern: str, alphabet: str, window: int, bits: float):
    """Whether a match of the class is as random as a secret and not on the allow-list."""
    def judge(rest: Column) -> Column:
        # longer hex is for entropy_hex to find
        mixed = rest.rlike("[a-z]") & rest.rlike("[A-Z]") | rest.rlike(CLASSES[0][1])
        least = F.lit(bits) if kind == "entropy_hex" else F.when(mixed, bits).otherwise(ONE_CASE)
        return F.when(F.length(rest) < window, F.lit(False)).otherwise(best_window_entropy(rest, alphabet, window) >= least)

    def check(m: Column) -> Column:
        random = judge(F.lower(m["text"])) if kind == "entropy_hex" else F.exists(_remains(m["text"]), judge)
        return F.when(m["text"].rlike(PLACEHOLDERS), F.lit(False)).otherwise(random)

    return check


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, the counts ``n_assign n_access n_hex`` and
    ``found`` array<struct<start, rank, end, kind>> ordered by start, then kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def long_value(m: Column) -> Column:
        return F.length(F.regexp_extract(m["text"], "^" + _ASSIGN + "(" + _VALUE + ")$", 1)) >= 6

    parts = [_spans(F.filter(_matches(text, ASSIGN), long_value), "assign", 0),
             _spans(_matches(text, ACCESS), "access", 1), _spans(_matches(text, HEX), "hex", 2)]
    for rank, entry in enumerate(CLASSES, 3):
        parts.append(_spans(F.filter(_matches(text, entry[1]), _random(*entry)), entry[0], rank))
    found = docs.select(F.col(id_col), F.array_sort(F.concat(*parts)).alias("found"))
    counts = [F.size(F.filter("found", _of(k))).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select(id_col, *counts, "found")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
