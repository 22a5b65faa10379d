"""Secret scan: patterns find candidates, a random forest removes false positives.

A candidate is a value of a known format, a value assigned to a telling name, or a long run of letters and
digits. Features are its length, its character classes and the transitions between them, its entropy, how
much of it a dictionary covers, what its path says, and words near it. The forest is trained on
labelled findings (text, begin, end, path, label): by default ``labelled_findings``, a generated set of
``TRAINING`` findings, or a table of them, of which a bounded sample is used.

Values are matched, measured and hashed whole, however long. Scanning is one pass without a shuffle over whole texts; the forest's size is bounded by its trees and
depth. Findings carry the place and hash of a value, not the value.

Defined cases: null and empty texts have no findings; a null doc_id or path is kept as null; repeated rows
are scanned each; overlapping candidates count once, the more specific pattern first; other columns are not
read.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, slices
from .forest import Forest

TRAINING = 6000
#: Formats that providers document, names of secrets, and words that tell other strings.
FORMATS = (
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]+?-----END [A-Z ]*PRIVATE KEY-----"),
    ("access_key_id", r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b"),
    ("forge_token", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}+|glpat-[A-Za-z0-9_-]{20,}+)"),
    ("chat_token", r"\bxox[abprs]-[A-Za-z0-9-]{10,}+"),
    ("api_key", r"\b(?:sk|pk|rk)[-_](?:live[-_]|test[-_]|proj-)?[A-Za-z0-9_-]{20,}+|\bAIza[0-9A-Za-z_-]{35}"),
    ("web_token", r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8})[A-Za-z0-9_-]*?\b(?P<value>eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)"),
    ("assigned", r"""(?i:[\w.-]{0,40}(?:key|token|secret|passwd|password|pwd|auth|credential|bearer)[\w.-]{0,40})["']?(?:\s{0,3}(?::=|=>|[=:])\s{0,3}|\s)["'`]?(?P<value>[^\s"'`,;<>(){}\[\]]{8,}+)"""),
    ("long_run", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}+={0,2}"),
)
_FIND = [(kind, re.compile(p)) for kind, p in FORMATS]
_KEY_END = re.compile("-----END [A-Z ]*PRIVATE KEY-----")
#: What every candidate has, in the dialect of Arrow's regular expressions, where \w and \s are ASCII: names and runs of letters are enough.
_MAYBE = r"-----BEGIN|AKIA|ASIA|gh[pousr]_|glpat-|xox[abprs]-|AIza|eyJ|[spr]k[-_]|[A-Za-z0-9+/_-]{20}|(?i:key|token|secret|passwd|password|pwd|auth|credential|bearer)"
TELLING = "key token secret password passwd pwd auth credential bearer api access private client login export env config".split()
OTHER = "commit sha sha1 sha256 sha512 md5 hash checksum digest integrity uuid guid id version revision build image data fixture cache etag blob tree parent".split()
COMMON = (
    "the and for your you this that here example sample test demo dummy fake change changeme insert replace placeholder none null true false user name "
    "password secret token key api value string default admin root localhost http https com org net www file path data image config service client server "
    "account public private access login auth code app web dev prod main index page content header footer style script function return class module "
    "import export package version build release debug error info message request response object array number foo bar baz qux xxx abc qwerty letmein "
    "my is of to in on with from not set get put add new old one two three first last time date year month day"
).split()
_DICTIONARY = re.compile("|".join(sorted((w for w in COMMON if len(w) > 2), key=lambda w: (-len(w), w))))
_TEST_PATH = re.compile(r"test|spec|fixture|example|sample|mock|docs?[/.]|readme|\.md$", re.I)
_LOCK_PATH = re.compile(r"lock|\.sum$|checksum|manifest|\.map$|min\.js|dist/", re.I)
_CONF_PATH = re.compile(r"\.env|conf|setting|secret|credential|\.ya?ml$|\.ini$|\.toml$|\.tf$", re.I)


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(begin, end, kind) of candidates that don't overlap, in order."""
    taken: list[tuple[int, int, str]] = []  # in order, so that a match is compared with its neighbours alone
    for kind, pattern in _FIND:
        # a key is looked for up to the last end of one, so that every beginning has an end and is read once
        last = max((m.end() for m in _KEY_END.finditer(text)), default=0) if kind == "private_key" else len(text)
        for m in pattern.finditer(text, 0, last):
            begin, end = m.span("value") if "value" in pattern.groupindex else m.span()
            if kind == "assigned" and not re.search(r"[^A-Za-z]|^[a-z]*+[A-Z]++[a-z]", text[begin:end]):
                continue
            at = bisect.bisect(taken, (begin, end))
            if (not at or taken[at - 1][1] <= begin) and (at == len(taken) or taken[at][0] >= end):
                taken.insert(at, (begin, end, kind))
    return taken


def _classes(s: str) -> str:
    return "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.islower() else "-" for c in s)


def features(text: str, begin: int, end: int, kind: str, path: str | None) -> list[float]:
    value = text[begin:end]
    n = len(value)
    classes = _classes(value)
    moves = Counter(zip(classes, classes[1:], strict=False))
    counts = Counter(value)
    low = value.lower()
    near_before = re.findall(r"[a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", text[max(0, begin - 60) : begin]).lower())[-5:]
    near_after = re.findall(r"[a-z0-9]+", text[end : end + 40].lower())[:3]
    sep = text[max(0, begin - 4) : begin]
    path = path or ""
    return [
        n, min(n, 64) % 8, len(counts) / n, -sum(c / n * math.log2(c / n) for c in counts.values()),
        *(classes.count(c) / n for c in "9Aa-"), *(moves[a, b] / max(1, n - 1) for a in "9Aa" for b in "9Aa"),
        sum(a != b for a, b in zip(classes, classes[1:], strict=False)) / max(1, n - 1),
        max(counts.values()) / n, sum(m.end() - m.start() for m in _DICTIONARY.finditer(low)) / n,
        float(re.fullmatch(r"[0-9a-fA-F]+", value) is not None), float(re.fullmatch(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", low) is not None),
        float(re.search(r"(.)\1{3}|1234|abcd", low) is not None), float("/" in value or "." in value),
        float(kind in ("assigned", "long_run")), float(kind == "assigned"), float(kind == "long_run"),
        float(any(w in x for x in near_before[-3:] for w in TELLING)), float(any(x in OTHER for x in near_before[-3:])), float(any(x in COMMON for x in near_before)),
        float(any(x in OTHER for x in near_after)), float("=" in sep), float(":" in sep), float('"' in sep or "'" in sep), float("/" in sep),
        float(bool(_TEST_PATH.search(path))), float(bool(_LOCK_PATH.search(path))), float(bool(_CONF_PATH.search(path))),
    ]


def labelled_findings(n: int = TRAINING, seed: int = 11) -> list[tuple[str, int, int, str, int]]:
    """(text, begin, end, path, label) of generated findings, half of them secrets."""
    rng = random.Random(seed)
    pick = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    hexes, upper = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    alnum = upper + upper.lower() + "0123456789"
    prose = lambda k: " ".join(pick("etaoinshrdlu", rng.randint(2, 9)) for _ in range(k))
    name = lambda: rng.choice(["token", "api_key", "secret", "password", "AUTH_TOKEN", "access_token", "client_secret", "apiKey", "TOKEN", "db_password"])
    value = lambda: rng.choice([lambda: pick(hexes, rng.choice([32, 40, 64])), lambda: pick(hexes, 40).upper(), lambda: pick(alnum, rng.randint(16, 48)), lambda: pick(alnum + "+/", 40), lambda: pick(alnum + "!@#%^&*", rng.randint(10, 20))])()
    good = [
        lambda: (f'{name()} = "', value(), '"'), lambda: (f"export {name().upper()}=", value(), ""), lambda: (f'"{name()}": "', value(), '",'), lambda: ("Authorization: Bearer ", pick(alnum, 40), ""),
        lambda: (f"{name()}: ", value(), ""), lambda: (f"{prose(5)} {name()} = '", value(), "' "), lambda: ("", "AKIA" + pick(upper + "0123456789", 16), ""), lambda: ("use ", "ghp_" + pick(alnum, 36), " "),
        lambda: ("key ", "sk-" + pick(alnum, 32), ""), lambda: ("", f"eyJ{pick(alnum, 20)}.eyJ{pick(alnum, 40)}.{pick(alnum, 43)}", ""),
    ]
    uuid = lambda: "-".join(pick(hexes, k) for k in (8, 4, 4, 4, 12))
    words = lambda k, sep: sep.join(rng.choice(COMMON) for _ in range(k)) + rng.choice(["", "1", "123", "2024"])
    bad = [
        lambda: ("commit ", pick(hexes, 40), "\n"), lambda: ("sha1: ", pick(hexes, 40), ""), lambda: ("md5 = ", pick(hexes, 32), ""), lambda: ('integrity="sha512-', pick(alnum + "+/", 86) + "==", '"'),
        lambda: ('"id": "', uuid(), '"'), lambda: ("uuid ", uuid(), " "), lambda: (f'{name()} = "', rng.choice(["your", "my", "insert", "example", "test"]) + "-" + words(3, "-"), '"'), lambda: (f"{name()}: ", "x" * rng.randint(8, 30), ""),
        lambda: (f'{name()} = "', words(3, "_"), '"'), lambda: ("/assets/app.", pick(hexes, 20), ".js"), lambda: ("", words(5, "_") + "1", "()"), lambda: ("data:image/png;base64,", pick(alnum + "+/", 60), ""),
        lambda: ("version v1.2.3-", "20240101120000-" + pick(hexes, 12), ""), lambda: ("checksum ", pick(hexes, 64), "  file.tar.gz"), lambda: (f"{name()} = ", "os.environ." + words(2, "_"), ""), lambda: ("blob ", pick(hexes, 40), " "),
        lambda: (f"{prose(3)} {name()} ", pick("etaoinshrdlu", rng.randint(8, 14)) + rng.choice([".", ",", ";", "-" + pick("etaoin", 5)]), " " + prose(3)),
    ]
    # a path makes a label likelier, and each occurs with both
    paths = [".env", "config/settings.py", "deploy.yaml", "src/app.py", "package-lock.json", "go.sum", "tests/test_app.py", "docs/setup.md", "dist/app.min.js", ""]
    odds = {1: [3, 3, 3, 3, 1, 1, 1, 1, 1, 8], 0: [1, 1, 1, 3, 3, 3, 2, 2, 2, 8]}
    out = []
    for i in range(n):
        label = i % 2
        before, v, after = rng.choice(good if label else bad)()
        before, after = prose(rng.randint(0, 6)) + " " + before, after + " " + prose(rng.randint(0, 6))
        out.append((before + v + after, len(before), len(before) + len(v), rng.choices(paths, odds[label])[0], label))
    return out


def train(findings: list[tuple[str, int, int, str | None, int]]) -> Forest:
    rows, labels = [], []
    for text, begin, end, path, label in findings:
        kind = next((k for a, b, k in candidates(text) if a < end and b > begin), "long_run")
        rows.append(features(text, begin, end, kind, path))
        labels.append(label)
    return Forest().fit(np.array(rows), np.array(labels))


def train_on(table: DataFrame, most: int = TRAINING) -> Forest:
    """Forest of labelled findings (text, begin, end, path, label); of more than ``most`` rows, those with the least hashes."""
    cols = ["text", "begin", "end", "path", "label"]
    rows = table.select(*cols).where("text is not null and label is not null").orderBy(F.xxhash64("text", "begin", "end"), *cols).limit(most).collect()
    return train([(r.text, r.begin, r.end, r.path, int(r.label)) for r in rows])


@functools.lru_cache(1)
def default_forest() -> Forest:
    return train(labelled_findings())


def scan(docs: DataFrame, *, forest: Forest | None = None, least: float = 0.5, path: str | None = None) -> DataFrame:
    """A row per candidate of docs (doc_id, text): its place in code points, kind, value's hash, probability and is_secret. path: name of a column."""
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(forest or default_forest())
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), (F.col(path).cast("string") if path else F.lit(None).cast("string")).alias("path"))

    def find(batches):
        for batch in slices(batches, 2000):
            maybe = pc.fill_null(pc.match_substring_regex(batch.column(1), _MAYBE), False)
            some = batch.filter(maybe)
            found, x = [], []
            for doc, text, where in zip(*(some.column(i).to_pylist() for i in range(3)), strict=True):
                for begin, end, kind in candidates(text):
                    found.append((doc, begin, end - begin, kind, hashlib.sha256(text[begin:end].encode("utf-8", "surrogatepass")).hexdigest()))
                    x.append(features(text, begin, end, kind, where))
            p = sent.value.predict(np.array(x)) if x else np.zeros(0)
            cols = [list(c) for c in zip(*found, strict=True)] if found else [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(cols, types, strict=True)), pa.array(p, pa.float64()), pa.array(p >= least, pa.bool_())], ["doc_id", "begin", "length", "kind", "value_sha256", "probability", "is_secret"])

    return rows.mapInArrow(find, "doc_id bigint, begin bigint, length bigint, kind string, value_sha256 string, probability double, is_secret boolean")
