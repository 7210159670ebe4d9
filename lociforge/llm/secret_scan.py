"""Secret scanning: candidate strings by pattern, then a random forest that removes false positives.

The forest sees a candidate's length, character transitions, dictionary coverage, path and neighbouring words, all of the whole value.  It is
trained from labelled findings: rows of (text, start, end, path, secret).  ``labelled_findings`` makes such rows from public credential formats and from
the usual look-alikes (checksums, ids, placeholders, urls); a caller's own labelled rows can take their place or join them.
The dictionary is ``DICTIONARY`` and, where a public tokenizer's rank file is given, the words of its vocabulary.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociforge.llm.worker import tidy_call

_NAMES = "password|passwd|passphrase|passcode|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|secret[_-]?key|auth[_-]?key|credentials?|auth"
_PREFIXES = r"glpat-|gh[pousr]_|github_pat_|xox[abeprs]-|[sr]k_(?:live|test)_|AIza|npm_|pypi-|SG\.|hf_|dop_v1_|AKIA|ASIA"
#: What may be a secret: a whole key block, a password in a url, a value after a telling name (alone or as part of a name), what
#: follows ``bearer``, a known prefix, or a long run of key characters with a digit.  No part repeats over another, so time is linear in the text.
CANDIDATE = re.compile(
    r"(?P<pem>-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----(?:(?:(?!-----(?:BEGIN|END) )[\s\S])*-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
    r"|(?:\s*(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset):[^\n]*)*(?:\s*[A-Za-z0-9+/=]{16,})*))"
    r"|(?<=://)[^\s:/@\"'<>]*:(?P<url>[^\s/@\"'<>]+)@"
    rf"|(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z]))(?i:{_NAMES})(?:[_.-][A-Za-z0-9]+){{0,3}}[\"']?\s{{0,8}}(?::=|=>|[:=])\s{{0,8}}"
    r"(?:\"(?P<double>[^\"\n]{6,})\"|'(?P<single>[^'\n]{6,})'|[\"']?(?P<bare>[^\s\"']{5,}[^\s\"',;.)\]}]))"
    r"|(?i:(?<![A-Za-z])bearer)\s{1,8}(?P<bearer>[A-Za-z0-9._~+/=-]{16,})"
    rf"|(?<![A-Za-z0-9])(?P<prefix>(?:{_PREFIXES})[A-Za-z0-9_.-]{{16,}})"
    r"|(?<![A-Za-z0-9+/_.-])(?P<run>(?=[A-Za-z+/_.-]*[0-9])[A-Za-z0-9+/_.-]{16,}+={0,2}+)(?![\"']?\s{0,8}[:=])"
)
#: The kind of a finding, by the pattern's group.
KINDS = {"pem": "pem", "url": "url", "double": "assigned", "single": "assigned", "bare": "assigned", "bearer": "token", "prefix": "token", "run": "token"}
NEAR = 48
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]{2,}")
_PREFIXED = re.compile(_PREFIXES + "|eyJ")
#: Words that people write, in names and placeholders; a parameter of the forest's features.
DICTIONARY = frozenset(
    "access account admin alpha app auth auto backup base beta build byte cache change client cloud code commit config core credential data date debug default demo deploy dev digest document domain draft dummy email enter error example "
    "fake file filter final first fixture format group guide hash header hello hidden host html http https image import index info insert internal item json key last latest level license line link list local login mail main manager master message meta model "
    "module name network node none null number object option order package page param pass password path placeholder port print private process product project public query random read release remote report request reset result root route sample save "
    "schema script search secret section server service session set setting site size source staging start state static storage string style sub super system table tag target task template temp test text time title token tool total type update upload url "
    "user utf value version view web welcome word work www your".split()
)
TELLING = frozenset("pass password passwd passphrase passcode pwd secret token key apikey auth credential credentials access private bearer login aws".split())
HARMLESS = frozenset("commit sha md5 checksum digest hash uuid guid version etag integrity example sample placeholder dummy fixture test id revision build isbn doi issue ticket".split())
HARMLESS_PATHS = frozenset("test tests example examples sample samples fixture fixtures docs doc lock mock mocks spec vendor".split())


class Finding(NamedTuple):
    text: str
    start: int
    end: int
    path: str
    secret: int


def candidates(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, kind) of every candidate in the text, in order, in code points."""
    for m in CANDIDATE.finditer(text):
        group = m.lastgroup
        yield m.start(group), m.end(group), KINDS[group]


def vocabulary_words(path: str, least: int = 4) -> frozenset[str]:
    """The words (a space, then lower-case letters) of a public tokenizer's rank file: tens of thousands at most."""
    found = set()
    with open(path, "rb") as f:
        for line in f:
            token = base64.b64decode(line.split()[0]) if line.strip() else b""
            if len(token) > least and token[:1] == b" " and token[1:].isalpha() and token[1:].islower() and token.isascii():
                found.add(token[1:].decode())
    return frozenset(found)


def _classes(value: str) -> np.ndarray:
    """0 to 25: letters, 26: digits, 27: the rest."""
    code = np.frombuffer(value.lower().encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.where((code >= 97) & (code <= 122), code - 97, np.where((code >= 48) & (code <= 57), 26, 27))


@dataclass(frozen=True)
class Lexicon:
    """Words and the log probabilities of their character transitions."""

    words: frozenset[str] = DICTIONARY
    moves: np.ndarray = field(init=False)
    longest: int = field(init=False)

    def __post_init__(self):
        counts = np.full((28, 28), 0.5)
        text = _classes(" ".join(sorted(self.words)))
        np.add.at(counts, (text[:-1], text[1:]), 1)
        object.__setattr__(self, "moves", np.log2(counts / counts.sum(1, keepdims=True)))
        object.__setattr__(self, "longest", max(map(len, self.words), default=0))

    def coverage(self, value: str) -> float:
        """Share of the value's characters in dictionary words, taken greedily from the left, longest first."""
        low, at, covered = value.lower(), 0, 0
        while at < len(low):
            size = next((n for n in range(min(self.longest, len(low) - at), 2, -1) if low[at : at + n] in self.words), 0) if low[at].isalpha() else 0
            covered += size
            at += size or 1
        return covered / max(1, len(low))

    def likelihood(self, value: str) -> float:
        """Mean log probability of the value's character transitions."""
        at = _classes(value)
        return float(self.moves[at[:-1], at[1:]].mean()) if len(at) > 1 else 0.0


def features(text: str, start: int, end: int, path: str, lexicon: Lexicon) -> list[float]:
    """Numbers about a candidate, of its whole value."""
    value = text[start:end]
    n = max(1, len(value))
    code = np.frombuffer(value.encode("utf-32-le"), np.uint32)
    lower, upper, digit = (code >= 97) & (code <= 122), (code >= 65) & (code <= 90), (code >= 48) & (code <= 57)
    kinds = lower * 1 + upper * 2 + digit * 3
    share = [float((kinds == k).mean()) if len(kinds) else 0.0 for k in (1, 2, 3, 0)]
    counts = np.unique(code, return_counts=True)[1] / n
    entropy = float(-(counts * np.log2(counts)).sum())
    before = [w.lower() for w in _WORD.findall(text[max(0, start - NEAR) : start])][-5:]
    after = [w.lower() for w in _WORD.findall(text[end : end + NEAR])][:3]
    steps = set(re.findall(r"[a-z]+", path.lower()))
    lead = text[max(0, start - 4) : start].rstrip(" \"'")
    hexadecimal = bool(re.fullmatch(r"[0-9a-fA-F]+", value))
    marks = value.count("-") + value.count(".") + value.count("/") + value.count("_")
    return [
        float(n), math.log2(n + 1), *share, float((kinds[1:] != kinds[:-1]).sum()) / n, entropy, entropy / math.log2(n + 1), float(counts.max(initial=0)),
        float(hexadecimal), marks / n, float(value.count(" ")), lexicon.coverage(value), lexicon.likelihood(value),
        float(len(TELLING.intersection(before))), float(len(HARMLESS.intersection(before))), float(len(HARMLESS.intersection(after))), float(len(HARMLESS_PATHS & steps)),
        float(lead.endswith(("=", ":", ">"))), float(text[end : end + 1] == "@"), float(value.startswith("-----BEGIN")), float(bool(_PREFIXED.match(value))),
        float(value.lower() in TELLING or any(w in value.lower() for w in ("example", "your", "placeholder", "xxxx", "changeme", "enter ", "please", "must not", "change the"))),
    ]


@dataclass(frozen=True)
class Tree:
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        while (inner := self.feature[at] >= 0).any():
            go = np.flatnonzero(inner)
            node = at[go]
            at[go] = np.where(x[go, self.feature[node]] <= self.cut[node], self.left[node], self.right[node])
        return self.share[at]


def _grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, least: int) -> Tree:
    """A tree on bootstrapped rows: the best Gini cut among a root's worth of random features at each node."""
    nodes: list[list[float]] = []
    tries = max(1, int(math.sqrt(x.shape[1])))

    def build(rows: np.ndarray, level: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, 0, 0, float(y[rows].mean())])
        if level >= depth or len(rows) < 2 * least or y[rows].min() == y[rows].max():
            return me
        best = (1e-9, -1, 0.0)
        base = 2 * y[rows].mean() * (1 - y[rows].mean())
        for f in rng.permutation(x.shape[1])[:tries]:
            order = np.argsort(x[rows, f], kind="stable")
            v, t = x[rows[order], f], np.cumsum(y[rows[order]])
            at = np.flatnonzero(v[1:] != v[:-1]) + 1
            at = at[(at >= least) & (at <= len(rows) - least)]
            if not len(at):
                continue
            left, right = t[at - 1] / at, (t[-1] - t[at - 1]) / (len(rows) - at)
            gain = base - (at * 2 * left * (1 - left) + (len(rows) - at) * 2 * right * (1 - right)) / len(rows)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                low, high = float(v[at[k] - 1]), float(v[at[k]])
                best = (float(gain[k]), int(f), low if (low + high) / 2 >= high else (low + high) / 2)
        if best[1] >= 0:
            go = x[rows, best[1]] <= best[2]
            nodes[me][0], nodes[me][1] = best[1], best[2]
            nodes[me][2] = build(rows[go], level + 1)
            nodes[me][3] = build(rows[~go], level + 1)
        return me

    build(rng.integers(0, len(y), len(y)), 0)
    table = np.array(nodes)
    return Tree(table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64), table[:, 3].astype(np.int64), table[:, 4])


@dataclass(frozen=True)
class Forest:
    trees: tuple[Tree, ...]
    lexicon: Lexicon

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.mean([t.predict(x) for t in self.trees], axis=0) if len(x) else np.zeros(0)


def fit_forest(findings: Sequence[Finding], trees: int = 30, depth: int = 12, least: int = 2, seed: int = 5, words: frozenset[str] = frozenset()) -> Forest:
    """A forest on labelled findings; the caller bounds their number (``labelled_findings`` makes ``rows``).  ``words`` join the dictionary."""
    lexicon = Lexicon(DICTIONARY | words)
    x = np.array([features(f.text, f.start, f.end, f.path, lexicon) for f in findings])
    y = np.array([f.secret for f in findings], float)
    rng = np.random.default_rng(seed)
    return Forest(tuple(_grow(x, y, rng, depth, least) for _ in range(trees)), lexicon)


def labelled_findings(rows: int = 3000, seed: int = 3) -> list[Finding]:
    """Labelled findings in invented sentences: public credential formats, and strings that only look like them."""
    rng = np.random.default_rng(seed)
    pick = lambda chars, n: "".join(chars[i] for i in rng.integers(0, len(chars), n))
    lower, upper, digit = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    hexa, mixed = digit + "abcdef", lower + upper + digit
    letters = "eeeeeetttttaaaaoooiiinnnsssrrrhhlldccuummffppggwwyybbvkk"
    word = lambda: pick(letters, int(rng.integers(2, 9)))
    size = lambda a, b: int(rng.integers(a, b))
    one = lambda *of: str(rng.choice(of))
    words = sorted(DICTIONARY)
    known = lambda: words[int(rng.integers(0, len(words)))]
    plain = lambda: one("password", "token", "secret", "api_key", "access_key", "auth", "passwd", "pwd", "private_key", "credential")

    def name() -> str:
        """A telling name, alone, after or before other words, in several cases."""
        base = plain()
        kind = size(0, 6)
        if kind == 1:
            return f"{known()}_{base}".upper()
        if kind == 2:
            return f"{known()}.{base}"
        if kind == 3:
            return f"{base}_{one('key', 'value', 'id', 'prod')}".upper()
        return f"{known()}{base.title().replace('_', '')}" if kind == 4 else base

    def block(title: str, head: str) -> str:
        lines = "\n".join(pick(mixed + "+/", 64) for _ in range(size(1, 8)))
        return f"-----BEGIN {title}-----\n{head}{lines}\n{pick(mixed + '+/', size(4, 60))}==\n-----END {title}-----"

    strong = lambda: pick(mixed + "!#%&*@$", size(8, 22))
    phrase = lambda n: " ".join(one(word(), known()) for _ in range(n))
    real = [
        lambda: ("", one("AKIA", "ASIA") + pick(upper + digit, 16), ""),
        lambda: (f"{name()}=", pick(hexa, size(16, 24)), ""),
        lambda: (f'{name()} = "', pick(hexa, one_of(32, 40, 64)), '"'),
        lambda: (f"{name()}: ", pick(mixed, size(16, 48)), ""),
        lambda: (f"{name()}{one('=', ': ', ' = ')}", strong(), ""),
        lambda: (f"{name()}={one(chr(34), chr(39))}", strong(), ""),
        lambda: (f"{name()}: ", f"{word()}{pick(upper, 3)}{size(100, 9999)}", ""),
        lambda: (f"{name()}: ", f"{word()}{one('!', '@', '#', '$')}{word()}{size(1, 99)}", ""),
        lambda: (f'{one("passphrase", "password", "PASSPHRASE", "key_passphrase")} {one("=", ":")} "', phrase(size(3, 7)), '"'),
        lambda: ("", one("ghp_", "gho_", "ghs_", "npm_", "hf_") + pick(mixed, 36), ""),
        lambda: ("", "glpat-" + pick(one(mixed, lower + upper, mixed + "-_"), 20), ""),
        lambda: ("", "xoxb-" + pick(digit, 12) + "-" + pick(mixed, 24), ""),
        lambda: (f"{one('', 'Authorization: ')}{one('bearer', 'Bearer')} ", one("eyJ" + pick(mixed, 33) + "." + pick(mixed, 60) + "." + pick(mixed + "_-", 43), pick(mixed + "-_", size(24, 60))), ""),
        lambda: ("", one("sk_live_", "rk_live_", "AIza") + pick(mixed, size(24, 36)), ""),
        lambda: (f"{one('aws secret', 'secret', 'private key', 'access key')} ", pick(mixed + "+/", 40), ""),
        lambda: (f"{one('postgres', 'mysql', 'amqp', 'https', 'redis', 'mongodb+srv')}://{one(word(), 'admin', 'root', '')}:", one(strong().replace("@", "x").replace("#", "y"), f"{one(word(), known())}{size(1, 99)}{one(word(), known())}", pick(mixed, size(8, 30))), f"@{word()}.{word()}:{size(1000, 9999)}/{word()}"),
        lambda: (f"{one('postgres', 'mysql', 'ftp', 'https')}://{one(word(), 'admin', known())}:", f"{one(word(), known())}{one('', '-', '_')}{size(1, 9999)}{one('', known())}", f"@{word()}.{word()}/{word()}"),
        lambda: (f'{one("passphrase", "password", "passwd")}{one(": ", " = ", "=")}"', phrase(size(3, 6)), '"'),
        lambda: ("", block(one("RSA PRIVATE KEY", "PRIVATE KEY", "OPENSSH PRIVATE KEY", "EC PRIVATE KEY"), one("", "", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC," + pick(upper[:6] + digit, 32) + "\n\n")), ""),
        lambda: ("", block("PGP PRIVATE KEY BLOCK", one("", "Version: GnuPG v2\n") + "\n"), ""),
        lambda: ("", "-----BEGIN RSA PRIVATE KEY-----" + pick(mixed + "+/", 64) + "-----END RSA PRIVATE KEY-----", ""),
    ]
    false = [
        lambda: (f"{one('commit', 'revision', 'sha', 'sha256', 'digest')}{one(' ', ': ', '=')}", pick(hexa, one_of(32, 40, 64)), ""),
        lambda: (f"{one('md5', 'checksum', 'etag', 'hash', 'integrity')}: ", pick(hexa, 32), ""),
        lambda: (one("uuid ", "id: ", "guid=", ""), "-".join(pick(hexa, n) for n in (8, 4, 4, 4, 12)), ""),
        lambda: (f"{name()}=", f"{one('your', 'my', 'insert', 'example')}_{known()}_{plain()}{one('_here', '')}", ""),
        lambda: (f"{name()}: ", f"{known()}{known()}{size(1, 9)}", ""),
        lambda: (f"{name()}{one(' = ', ': ', '=')}", one(f"<{known()}-{known()}>", f"${{{known()}_{plain()}}}".upper(), f"os.environ[{known()}]", f"get_{plain()}()", f"{known()}.{plain()}", f"%{known()}%", f"{{{{{known()}.{plain()}}}}}"), ""),
        lambda: (f'{name()} = "', f"{one('enter', 'the', 'your', 'please enter', 'must not be', 'change the')} {known()} {one('here', plain(), known())}", '"'),
        lambda: ("", f"{known()}-{known()}-{known()}-{size(1, 99)}.{size(0, 20)}.{size(0, 20)}", ""),
        lambda: ("", f"{known()}/{known()}/{word()}_{word()}{size(1, 99)}.{one('html', 'py', 'txt')}", ""),
        lambda: (one("call ", "card ", "", "isbn "), pick(digit, size(16, 20)), ""),
        lambda: (f"{name()}=", one("x", "*", ".", "-") * size(8, 20), ""),
        lambda: (f"{name()}: ", word() + word(), ""),
        lambda: (f"{name()}: ", one("required", "optional", "disabled", "undefined", "string,", "boolean", "expired"), ""),
        lambda: ("", f"{pick(digit, 4)}-{pick(digit, 2)}-{pick(digit, 2)}T{pick(digit, 2)}.{pick(digit, 2)}.{pick(digit, 2)}", ""),
        lambda: ("", f"{word()}.{word()}{size(1, 99)}.example.com", ""),
        lambda: ("", f"{word()}{word()}_{word()}{size(0, 99)}_{word()}{word()}", ""),
        lambda: ("example ", f"AKIA{'EXAMPLE' * 2}{pick(digit, 2)}", ""),
        lambda: ("https://user:", one("password", "pass", "secret"), f"@{one('example.com', 'host', 'localhost')}/"),
        lambda: (f"{one('bearer', 'Bearer')} ", f"{one('authentication', 'certificates', 'responsibilities')}-{known()}-{known()}", ""),
    ]
    one_of = lambda *of: int(rng.choice(of))
    out = []
    for i in range(rows):
        secret = i % 2
        before, value, after = (real if secret else false)[int(rng.integers(0, len(real if secret else false)))]()
        lead = " ".join(word() for _ in range(size(2, 8))) + " " + before
        text = lead + value + after + " " + " ".join(word() for _ in range(size(2, 8)))
        harmless = rng.random() < (0.05 if secret else 0.3)
        path = f"{rng.choice(['tests', 'examples', 'docs', 'fixtures'])}/{word()}" if harmless else f"{word()}/{word()}"
        out.append(Finding(text, len(lead), len(lead) + len(value), path, secret))
    return out


def scan_text(text: str, path: str, forest: Forest) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) of all candidates of one text."""
    found = list(candidates(text))
    if not found:
        return []
    scores = forest.score(np.array([features(text, s, e, path, forest.lexicon) for s, e, _ in found]))
    return [(s, e, k, float(p)) for (s, e, k), p in zip(found, scores, strict=True)]


_FINDINGS = "array<struct<start: int, end: int, kind: string, score: double>>"


def findings(forest: Forest, text: Column, path: Column) -> Column:
    """Candidates of each whole text with their scores; none for null and empty texts."""

    def run(texts: pa.Array, paths: pa.Array) -> pa.Array:
        rows = [[dict(zip(("start", "end", "kind", "score"), f, strict=True)) for f in scan_text(t or "", p or "", forest)] for t, p in zip(texts.to_pylist(), paths.to_pylist(), strict=True)]
        return pa.array(rows, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("score", pa.float64())])))

    return F.arrow_udf(run, _FINDINGS)(text, path)


def scan_secrets(docs: DataFrame, forest: Forest, threshold: float = 0.5, doc: str = "doc_id", text: str = "text", path: str | None = "source") -> DataFrame:
    """A row per candidate: doc_id, start, end (code points), kind, score, secret.

    ``path`` names a column whose words count as the file's path (null or none: empty).  Null and empty texts have no candidates;
    rows are judged one by one, so repeated rows have repeated findings.  Values of any length are judged as a whole; an empty
    table has no rows, and other columns, whatever their names, play no part.
    """
    where = F.col(path).cast("string") if path else F.lit("")
    got = docs.select(F.col(doc).alias("doc_id"), F.explode(findings(forest, F.col(text), where)).alias("f"))
    return got.select("doc_id", "f.start", "f.end", "f.kind", "f.score", (F.col("f.score") >= threshold).alias("secret"))


def redact_secrets(docs: DataFrame, forest: Forest, threshold: float = 0.5, mask: str = "[SECRET]", text: str = "text", path: str | None = "source") -> DataFrame:
    """``docs`` with every found secret in ``text`` replaced by ``mask``; all rows and columns stay, null texts stay null."""

    def run(texts: pa.Array, paths: pa.Array) -> pa.Array:
        out = []
        for t, p in zip(texts.to_pylist(), paths.to_pylist(), strict=True):
            if t:
                parts, at = [], 0
                for s, e, _, score in scan_text(t, p or "", forest):
                    if score >= threshold:
                        parts += [t[at:s], mask]
                        at = e
                t = "".join([*parts, t[at:]])
            out.append(t)
        return pa.array(out, pa.string())

    where = F.col(path).cast("string") if path else F.lit("")
    return docs.withColumn(text, F.arrow_udf(tidy_call(run), "string")(F.col(text), where))
