"""Secret scan with DataFrame functions only: fixed patterns, and sliding-window Shannon entropy over candidate strings.

A candidate is a run of WINDOW or more of the characters of key material, without allow-listed strings: those cut a run, and
what stands on either side is judged alone. Its class is the narrowest one that holds all its characters; each class has its
own least entropy. The window slides by one character: only the counts of the character that enters and of the one that
leaves change, and with them the sum of c*log2(c), kept in whole millionths so that results are exact.

Work grows with the length of a text: long candidates are read in blocks, and running sums over a text's matches are made in
blocks of about the square root of their number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kind, pattern, group whose length counts, least length. Leftmost, non-overlapping; shorter matches are dropped. For access and
#: hex the least length stands in the pattern: what is left of a run is shorter than the run, so the matches are the same.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
WINDOW = 20
KEY = "[A-Za-z0-9+/_=-]"
CANDIDATE = KEY + "{%d,}" % WINDOW
#: Never secrets, wherever they stand in a run: UUIDs and placeholders.
ALLOWED = "(?:[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}|(?i:example|placeholder|changeme|xxxxx|00000|12345))"
#: What a run that holds an allowed string is cut into: allowed strings (too short to count), and the rest of WINDOW or more.
PIECE = f"{ALLOWED}|(?:(?!{ALLOWED}){KEY}){{{WINDOW},}}+"
#: Parts between separators that are words or numbers, camel case too: a candidate of nothing else is a name or a path.
SEPARATORS, WORD_LIKE = "[+/_=-]+", "^(?:[0-9]*|[a-z]+|[A-Z]+|[a-z]*(?:[A-Z][a-z]{2,})*+)$"
#: Classes from narrow to wide, with the least entropy in bits of some window.
CLASSES = (("hex", "^[0-9A-Fa-f]+$", 3.0), ("lower", "^[0-9a-z]+$", 3.6), ("upper", "^[0-9A-Z]+$", 3.6), ("alnum", "^[0-9A-Za-z]+$", 3.7), ("base64", "^[A-Za-z0-9+/=]+$", 3.85), ("url", "", 3.85))
#: Windows of a block.
BLOCK = 200


def _scaled(c: int) -> int:
    return round(c * math.log2(c) * 1e6) if c else 0


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _running(values: str, combine: str, zero: str) -> str:
    """SQL for the running results of combine (over a and x) before each of values and after the last, by chunks."""
    step = f"(r, x) -> array_append(r, transform(array(element_at(r, -1)), a -> {combine})[0])"
    chunk = "CAST(ceil(sqrt(size(v))) AS int)"
    chunks = f"transform(sequence(0, (size(v) - 1) div {chunk}), c -> aggregate(slice(v, c * {chunk} + 1, {chunk}), array({zero}), {step}))"
    starts = f"aggregate(transform(parts, p -> element_at(p, -1)), array({zero}), {step})"
    shifted = f"zip_with(parts, slice({starts}, 1, size(parts)), (p, a) -> transform(slice(p, 1, size(p) - 1), x -> {combine}))"
    return f"transform(array({values}), v -> CASE WHEN size(v) = 0 THEN slice(array({zero}), 1, 0) ELSE transform(array({chunks}), parts -> flatten({shifted}))[0] END)[0]"


def _found(text: str, pattern: str) -> str:
    """SQL for the leftmost, non-overlapping matches as (m, start, end), in code points, in one pass over matches and the texts between."""
    lit = _literal(pattern)
    pairs = f"transform(array(regexp_extract_all({text}, {lit}, 0)), m -> zip_with(slice(split({text}, {lit}, -1), 1, size(m)), m, (b, y) -> named_struct('m', y, 'b', char_length(b), 'n', char_length(y))))[0]"
    before = _running("transform(q, x -> x.b + x.n)", "a + x", "0")
    placed = f"transform(array({pairs}), q -> zip_with(q, {before}, (x, at) -> named_struct('m', x.m, 'start', at + x.b, 'end', at + x.b + x.n)))[0]"
    return f"CASE WHEN regexp_like({text}, {lit}) THEN {placed} ELSE CAST(array() AS array<struct<m:string,start:int,end:int>>) END"


def _lowest(candidate: str) -> str:
    """SQL for the smallest sum of c*log2(c) over all windows of the candidate."""
    gains = "array(" + ",".join(f"{_scaled(c + 1) - _scaled(c)}L" for c in range(WINDOW)) + ")"  # of one more, by the count before
    gain = lambda among, n, c: f"element_at({gains}, {n} + 1 - char_length(replace({among}, {c}, '')))"
    first = f"aggregate(sequence(1, {WINDOW}), 0L, (s, k) -> s + {gain('substring(w, 1, k - 1)', 'k - 1', 'substring(w, k, 1)')})"
    stay = f"substring(w, k + 1, {WINDOW - 1})"  # what the windows at k and k + 1 share
    moved = f"a.s - {gain(stay, WINDOW - 1, 'substring(w, k, 1)')} + {gain(stay, WINDOW - 1, f'substring(w, k + {WINDOW}, 1)')}"
    places = f"slice(sequence(1, greatest(char_length(w) - {WINDOW}, 1)), 1, char_length(w) - {WINDOW})"
    start = f"transform(array({first}), s -> named_struct('s', s, 'best', s))[0]"
    least = f"aggregate({places}, {start}, (a, k) -> named_struct('s', {moved}, 'best', least(a.best, a.s)), a -> least(a.best, a.s))"
    cut = _literal(f"({KEY}{{1,{BLOCK}}})(?=({KEY}{{0,{WINDOW - 1}}}))")
    blocks = f"zip_with(regexp_extract_all({candidate}, {cut}, 1), regexp_extract_all({candidate}, {cut}, 2), (x, y) -> concat(x, y))"
    return f"array_min(transform(filter({blocks}, w -> char_length(w) >= {WINDOW}), w -> {least}))"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, bases and added: for each row of docs, arrays of (start, rank, kind, end), sorted; code points, end exclusive.

    Null and empty texts have none. Entropy spans inside a span of a fixed pattern are left out. Texts of millions of
    characters are read whole, in time that grows with their length. Every row keeps its own result, repeated rows too. Only
    doc_id and text are read, so other columns may have any name.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_t"))
    rows = rows.withColumns({f"_{kind}": F.expr(_found("_t", pattern)) for kind, pattern, _, _ in KINDS} | {"_runs": F.expr(_found("_t", CANDIDATE))}).drop("_t")
    base = []
    for rank, (kind, pattern, group, least) in enumerate(KINDS):
        long = f"char_length(regexp_extract(x.m, {_literal(pattern)}, {group})) >= {least}"
        base.append(F.expr(f"transform(filter(_{kind}, x -> {long}), x -> named_struct('start', x.start, 'rank', {rank}, 'kind', '{kind}', 'end', x.end))"))
    rows = rows.select("doc_id", F.array_sort(F.concat(*base)).alias("bases"), "_runs")
    return rows.select("doc_id", "bases", F.array_sort(_high()).alias("added"))


def _pieces() -> str:
    """SQL for the candidates: _runs, cut at allowed strings."""
    shifted = f"transform({_found('r.m', PIECE)}, p -> named_struct('m', p.m, 'start', r.start + p.start, 'end', r.start + p.end))"
    cut = f"flatten(transform(_runs, r -> CASE WHEN r.m RLIKE {_literal(ALLOWED)} THEN {shifted} ELSE array(r) END))"
    return f"filter({cut}, c -> char_length(c.m) >= {WINDOW} AND NOT forall(split(c.m, {_literal(SEPARATORS)}), w -> w RLIKE {_literal(WORD_LIKE)}))"


def _high() -> Column:
    """Of the candidates, those of enough entropy that no span in bases covers: in the order of starts (bases first), a span
    covers a candidate if the furthest end before it isn't before the candidate's end."""
    most = lambda bits: round((math.log2(WINDOW) - bits) * WINDOW * 1e6)
    classes = "CASE " + " ".join(f"WHEN c.m RLIKE '{p}' THEN {most(bits)}" for _, p, bits in CLASSES[:-1]) + f" ELSE {most(CLASSES[-1][2])} END"
    entries = lambda rows, is_run, m: f"transform({rows}, x -> named_struct('start', x.start, 'run', {is_run}, 'end', x.end, 'm', {m}))"
    both = f"array_sort(concat({entries('bases', 0, chr(39) * 2)}, {entries(_pieces(), 1, 'x.m')}))"
    reach = _running("transform(q, x -> if(x.run = 0, x.end, -1))", "greatest(a, x)", "-1")
    open_runs = f"transform(array({both}), q -> filter(zip_with(q, {reach}, (x, upto) -> if(x.run = 1 AND upto < x.end, x, NULL)), x -> x IS NOT NULL))[0]"
    kept = f"filter({open_runs}, c -> {_lowest('c.m')} <= {classes})"
    return F.expr(f"transform(CASE WHEN size(_runs) = 0 THEN slice({entries('bases', 0, chr(39) * 2)}, 1, 0) ELSE {kept} END, c -> named_struct('start', c.start, 'rank', {len(KINDS)}, 'kind', 'entropy', 'end', c.end))")


def digest(docs: DataFrame) -> DataFrame:
    """The counts, hash and spans of scan()."""
    told = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    rows = scan(docs)
    counts = [F.expr(f"CAST(size(filter(bases, x -> x.kind = '{kind}')) AS long)").alias(f"n_{kind}") for kind, *_ in KINDS]
    return rows.select("doc_id", *counts, F.size("added").cast("long").alias("n_entropy"), F.sha2(told(F.col("bases")), 256).alias("base_sha256"), told(F.array_sort(F.concat("bases", "added"))).alias("spans"))
