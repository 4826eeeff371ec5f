"""Secret scans: fixed patterns, and dictionary-primed zstandard novelty.

The novelty of a candidate is its marginal compressed size: how many bytes more
zstandard needs for the surrounding code with the candidate than without it,
with a dictionary of words of the corpus and common identifiers loaded. What the
dictionary or the surroundings explain costs little; random material costs most
of its length. A candidate is a run of key characters that begins within
``REACH`` characters of a sensitive word (or goes on from it), however far it
extends, and of at least 16 characters: shorter ones cost too little more than
words to be told from them, and are never measured. It is reported as kind ``novel`` if it costs ``MIN_RATIO`` of what a
random string of its length and alphabet would (see ``random_cost``), unless a
pattern has reported part of it already.

The words are those that most of all documents have, ``WORDS`` of them at most,
as the dictionary has that size. Letters only and no longer than words are, so
that a key that copies repeat can't become one.

Measured on keys planted in contexts that the patterns miss (see tests): of 24
random letters, or letters and digits, 19 in 20 or more are found, of 16 three in
four, of 20 small letters half; of words of 16 and more letters in such places one
in ten is taken for a key.

Defined results: a null text is empty and has no span; positions are code
points with the end excluded; novel spans overlap no other; repeated rows return
repeated rows; an empty table returns no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bin_of, checkpointed

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Words that make what follows them sensitive (fixed values).
CONTEXT = re.compile(r"(?:passw(?:or)?d|passphrase|pwd|secret|token|credential|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?id|bearer|authorization|auth|signature|session|cookie)", re.IGNORECASE | re.ASCII)
#: A whole run of key characters, and what goes on from a sensitive word inside one.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_~.-])[A-Za-z0-9+/_~.-]{16,}={0,2}")
REST = re.compile(r"[_~.-]*([A-Za-z0-9+/_~.-]{16,}={0,2})")
REACH, LEAST = 64, 16
#: Characters around a candidate that it is measured against: one reading alone depends on how well their code happens to fit.
AROUND = (48, 96, 160, 256)
MIN_RATIO = 0.9
WORDS, IN_DOCUMENTS = 4000, 3
WORD = "[A-Z]?[a-z]{3,13}"

#: Common identifiers and words of code, which a secret is not (fixed values).
IDENTIFIERS = """
public private protected static final class interface import package return function const let var def self this
string integer boolean float double long null none true false undefined default value values result response request
username user_name userId user_id client_id client_secret access_token refresh_token id_token token_type expires_in
authorization authentication credentials password passwd secret api_key apiKey API_KEY SECRET_KEY ACCESS_KEY_ID
database connection string host port localhost 127.0.0.1 example.com http:// https:// www. .com .org .net .json .yaml
config configuration settings environment variable process.env os.environ getenv export production development staging
session cookie header bearer basic digest signature certificate public_key private_key BEGIN END RSA KEY CERTIFICATE
your_api_key_here your-secret-key changeme placeholder xxxxxxxxxxxxxxxx 0123456789abcdef abcdefghijklmnopqrstuvwxyz
ABCDEFGHIJKLMNOPQRSTUVWXYZ 1234567890 00000000000000000000 application/json content-type utf-8 charset Mozilla/5.0
select from where insert into update delete create table index primary key foreign references not null varchar
logger logging debug info warning error exception throw catch finally try except raise assert test example sample
"""


class Novelty:
    """Marginal compressed bytes of a candidate within its surroundings."""

    def __init__(self, words: list[str] = ()):
        # what stands last is the cheapest to refer to
        primed = zstandard.ZstdCompressionDict(" ".join([*reversed(words), IDENTIFIERS]).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False, write_checksum=False)

    def size(self, data: str) -> int:
        return len(self.compressor.compress(data.encode("utf-8", "surrogatepass")))

    def marginal(self, text: str, start: int, end: int) -> int:
        """The most of the readings."""
        own, costs = text[start:end], []
        for n in AROUND:
            around = text[max(0, start - n) : start] + text[end : end + n]
            costs.append(self.size(around + own) - self.size(around))
        return max(costs)


def random_cost(value: str) -> float:
    """Bytes that random characters of value's kinds would cost: some 4 more than
    their entropy, and no fewer than their number up to 20, as short ones don't
    pay for a code of their own."""
    letters = {c.lower() for c in value if c.isalpha()}
    digits = any(map(str.isdigit, value))
    if digits and letters <= set("abcdef"):
        size = 16
    else:
        size = 10 * digits + 26 * (any(map(str.islower, value)) + any(map(str.isupper, value)))
    size += len({c for c in value if not c.isalnum()})
    return max(len(value) * math.log2(max(2, size)) / 8 + 4, min(len(value), 20))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns, in order of start, then kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty) -> list[tuple[int, int, int]]:
    """(start, 3, end) of incompressible candidates in sensitive contexts."""
    runs = [(m.start(), m.end()) for m in CANDIDATE.finditer(text)]
    starts = [s for s, _ in runs]
    near: dict[int, int] = {}  # start of a candidate by its end
    within: dict[int, int] = {}  # by run, where its last sensitive word that enough follows ends
    for c in CONTEXT.finditer(text):
        at = bisect_left(starts, c.end())
        if at and c.end() + LEAST <= runs[at - 1][1] and REST.match(text, c.end(), min(len(text), c.end() + 4 * LEAST)):
            within[at - 1] = c.end()
        while at < len(runs) and starts[at] <= c.end() + REACH:
            near.setdefault(runs[at][1], starts[at])
            at += 1
    for run, begin in within.items():  # the last sensitive word within a run counts
        m = REST.match(text, begin)
        near[m.end()] = m.start(1)
    begins, reach = [b for b, _, _ in base], list(accumulate((x for _, _, x in base), max))
    out = []
    for e, s in sorted(near.items()):
        before = bisect_left(begins, e)
        if before and reach[before - 1] > s:  # overlaps one of the base
            continue
        if novelty.marginal(text, s, e) >= MIN_RATIO * random_cost(text[s:e]):
            out.append((s, 3, e))
    return out


def corpus_words(docs: DataFrame, most: int = WORDS, text_col: str = "text") -> list[str]:
    """The words that most documents have, the commonest first.

    Words of all documents are counted in Spark. Bins of the counts tell from
    which count on there are ``most`` words, so that a partition sends the driver
    no others.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    words = rows.select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))).alias("word"))
    counts = checkpointed(words.groupBy("word").count().filter(F.col("count") >= IN_DOCUMENTS))
    least, held = IN_DOCUMENTS, 0
    for r in counts.groupBy(bin_of(F.col("count")).alias("bin")).agg(F.count("*").alias("n")).orderBy(F.desc("bin")).collect():
        if held < most:
            least, held = r.bin, held + r.n
    top = counts.filter(F.col("count") >= least).orderBy(F.desc("count"), "word").limit(most)
    return [r.word for r in top.collect()]


SPAN = "struct<kind: string, start: int, end: int, value: string, marginal_bytes: int>"


def scan(docs: DataFrame, words: list[str] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans: array of (kind, start, end, value, marginal_bytes). words:
    of the corpus, the commonest first."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("marginal_bytes", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(words)
        for b in batches:
            found = []
            for t in b.column(1):
                text = t.as_py() or ""
                base = base_spans(text)
                spans = sorted(base + novel_spans(text, base, novelty))
                found.append([{"kind": KINDS[k], "start": s, "end": e, "value": text[s:e], "marginal_bytes": novelty.marginal(text, s, e)} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(span))], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, spans array<{SPAN}>")


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
