"""Personal data replaced by keyed surrogates of the same type and format.

Surrogates of numbers, addresses and secrets come from a keyed permutation of all strings of the same shape
(a Feistel network that is walked until it stays in range), so different originals stay different and equal ones
equal, everywhere in the corpus. Kept are a card's issuer digit and a right check digit, a phone's country code, an
address's top-level domain, an IP address's private range and a secret's known prefix. People named with a title
get another name of the same gender and script. Names are drawn by a keyed hash and may meet; each further draw adds a
syllable, so there are always enough of them. A surname's surrogate depends on its word alone, whatever the title and
the given name; a given name's on its word, title and, where two full names would meet, on a further draw. Names are
found after a title; other mentions of such a name in the same document, whole or one of its words, are replaced too.

A check over all different originals of the corpus finds surrogates that two originals share, or that are
themselves originals; all but the smallest original draw again until none is left. Where the originals fill more
than a share of 1 / DENSE of a permutation's range (192.168.0.0/16, say), too few other strings are left: there a
surrogate may be another's original, and all draw again together until none is its own surrogate; the permutation
keeps them different. A string without another one of its shape stays. The exceptions go to the documents that
mention them by a join.

Null and empty texts stay empty and have no spans; repeated rows get equal results. Texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import SMALL_IDS, cut, frugal, keyed, load
from .runs import with_lists

#: The session's setting that holds the key of the registered query and the pipeline, and what they take where it is unset.
KEY_SETTING, SHOWN_KEY = "spark.tidemark.surrogates.key", "for tests and demonstrations only"
#: A range is dense if its originals times this are more than its strings; in others a draw meets nothing 3 times of 4.
DENSE = 8

_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_IP = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)")
_CARD = re.compile(r"(?<![\d-])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{13,19})(?![\d-])")
_PHONE = re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]?\d{4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)")
_SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_KEY = re.compile(r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)|(?<!\w)(?:ghp_|sk-|xox[bp]-)[A-Za-z0-9-]{16,}")
_SECRET = re.compile(r"(?:[Pp]assword|PASSWORD|[Pp]asswd|[Ss]ecret|SECRET|[Tt]oken|TOKEN|[Aa]pi[_-]?[Kk]ey|API_KEY)\s*[=:]\s*[\"']?([A-Za-z0-9+/_=.-]{8,})")
#: Titles, and the gender they tell.
_TITLES = {"Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f", "Dr": "n", "Prof": "n", "Господин": "m", "Госпожа": "f"}
_WORD = "[A-ZÀ-ÞА-Я][a-zß-ÿа-яё]+"
_NAME = re.compile(r"(?<!\w)(" + "|".join(_TITLES) + rf")\.? ({_WORD}(?:[ -]{_WORD}){{0,2}})(?!\w)")
_FIRST, _NEXT = re.compile(rf"(?<!\w){_WORD}"), re.compile(rf"[ -]{_WORD}")
#: Given names by script and gender.
_GIVEN = {
    ("latin", "m"): "Adam Albert Anton Bruno Carl Daniel David Emil Erik Felix Frank Georg Henry Hugo Jacob James Jonas Karl Leon Louis Lucas Marco Martin Oscar Otto Paul Peter Robert Simon Thomas".split(),
    ("latin", "f"): "Alice Amelia Anna Beatrice Carla Clara Diana Elena Ella Emma Eva Frida Grace Hanna Helen Ida Irene Julia Laura Lena Lucia Maria Marta Nina Nora Olivia Paula Rosa Sara Sofia".split(),
    ("latin", "n"): "Alex Andrea Ariel Charlie Chris Dominique Eden Jamie Jordan Jules Kim Lou Marion Maxime Morgan Noa Robin Sacha Sam Taylor".split(),
    ("cyrillic", "m"): "Андрей Антон Борис Виктор Глеб Денис Егор Иван Кирилл Максим Никита Олег Павел Роман Фёдор".split(),
    ("cyrillic", "f"): "Алина Анна Вера Галина Дарья Елена Жанна Ирина Ксения Лариса Марина Нина Ольга Полина Юлия".split(),
    ("cyrillic", "n"): "Женя Никита Саша Слава Шура Валя".split(),
}
_BEGIN = {"latin": "Al Ar Bar Bel Ber Bran Cal Car Dal Dor El Fal Far Gar Gol Hal Har Kel Kor Lan Lor Mal Mar Nor Or Pel Ran Ros Sal Tar Tol Val Ver Wal Wer".split(),
          "cyrillic": "Ба Бел Вол Гор Дан Зим Кар Кол Лан Мар Ник Ор Пав Рож Сол Тар Фил Чер".split()}
_MIDDLE = {"latin": "a e i o an en in on ar er or al el il".split(), "cyrillic": "а е и о ан ен ин ар ер ор".split()}
_END = {"latin": "berg dale feld ford gard hart land ley lund man mont nes rick sen son stad ton vall ville wick wood".split(), "cyrillic": "ков нов лов дов ской цев".split()}


def _mac(key: bytes, *parts: object, size: int = 16) -> int:
    """A number of `size` keyed pseudo-random bytes."""
    seed = hmac.new(key, "\0".join(map(str, parts)).encode(), hashlib.sha256).digest()
    return int.from_bytes(seed[:size] if size <= 32 else hashlib.shake_256(seed).digest(size), "big")


def permute(key: bytes, tweak: str, x: int, n: int) -> int:
    """A keyed permutation of range(n)."""
    if n < 2:
        return x
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        a, b = x >> half, x & mask
        for r in range(6):
            a, b = b, a ^ (_mac(key, tweak, n, r, b, size=half // 8 + 1) & mask)
        x = (a << half) | b
        if x < n:
            return x


#: Alphabets that a character is replaced within.
_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def reshape(key: bytes, tweak: str, text: str, alphabets: tuple[str, ...] = _ALPHABETS) -> str:
    """Another string with the same kind of character in each place; others than those of the alphabets stay."""
    if len(text) > 64:
        return "".join(reshape(key, f"{tweak}/{i}", text[i : i + 64], alphabets) for i in range(0, len(text), 64))
    kinds = [next((a for a in alphabets if c in a), "") for c in text]
    value, size = 0, 1
    for c, a in zip(text, kinds):
        if a:
            value, size = value * len(a) + a.index(c), size * len(a)
    shape = "".join(c if not a else str(alphabets.index(a)) for c, a in zip(text, kinds))
    value = permute(key, f"{tweak}/{shape}", value, size)
    out = []
    for c, a in zip(reversed(text), reversed(kinds)):
        if a:
            value, i = divmod(value, len(a))
            c = a[i]
        out.append(c)
    return "".join(reversed(out))


def luhn(digits: str) -> int:
    """The check digit that follows the digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def is_card(text: str) -> bool:
    """Whether digits are a payment card's: an issuer's first digit, and the check digit is right. Other long numbers stay."""
    d = "".join(filter(str.isdigit, text))
    return d[0] in "23456" and luhn(d[:-1]) == int(d[-1])


def _fill(shape: str, digits: str) -> str:
    """The digits put in the places of the shape's digits."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in shape)


_PRIVATE = [ipaddress.ip_network(n) for n in ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "127.0.0.0/8")]
_HEAD, _PREFIX = re.compile(r"\+\d{1,3}(?=\D)|"), re.compile(r"AKIA|ASIA|ghp_|sk-|xox[bp]-")
#: A phone number with the exchange of invented numbers.
_INVENTED = re.compile(r"(\D*)(\d{3})(\D+)555(\D?)(\d{4})")


def _net(ip: ipaddress.IPv4Address) -> ipaddress.IPv4Network | None:
    return next((n for n in _PRIVATE if ip in n), None)


def _shape(text: str, alphabets: tuple[str, ...] = _ALPHABETS) -> tuple[str, int]:
    """What reshape() keeps of a text, and how many strings have it."""
    shape, size = [], 1
    for c in text:
        k = next((i for i, a in enumerate(alphabets) if c in a), None)
        shape.append(c if k is None else f"\0{k}")
        size *= 1 if k is None else len(alphabets[k])
    return "".join(shape), size


def place(kind: str, text: str) -> tuple[str, int]:
    """The range that surrogate() permutes an original within, and how many strings it has; ("", 0) for names."""
    if kind == "surname" or kind.startswith("name/"):
        return "", 0
    if kind == "email":
        local, domain = text.rsplit("@", 1)
        name, top = domain.rsplit(".", 1)
        (a, m), (b, n) = _shape(local), _shape(name)
        return f"email/{a}@{b}.{top}", m * n
    if kind == "ip":
        net = _net(ipaddress.IPv4Address(text))
        return f"ip/{net}", net.num_addresses if net else (1 << 32) - sum(n.num_addresses for n in _PRIVATE)
    if kind == "card":
        d = "".join(filter(str.isdigit, text))
        return f"card/{d[0]}/{_shape(text)[0]}", 10 ** (len(d) - 2)
    if kind == "phone":
        head = _HEAD.match(text).group()
        rest = text[len(head) :]
        shape, size = _shape(rest)
        return (f"phone/{head}/555{shape}", 10**7) if _INVENTED.fullmatch(rest) else (f"phone/{head}/{shape}", size)
    fixed = text[:2] if kind == "iban" else _PREFIX.match(text).group() if kind == "key" else ""
    if not fixed and re.fullmatch("[0-9a-f]+", text):
        return f"{kind}/hex/{len(text)}", 16 ** len(text)
    shape, size = _shape(text[len(fixed) :])
    return f"{kind}/{fixed}/{shape}", size


def _script(name: str) -> str:
    return "cyrillic" if re.search("[Ѐ-ӿ]", name) else "latin"


def _given(key: bytes, kind: str, name: str, draw: int) -> str:
    """The replacement of a full name's first word; each further draw adds a given name."""
    n, given = _mac(key, f"{kind}/{draw}", 0, re.split("[ -]", name)[0], size=16 + draw), _GIVEN[_script(name), kind[5:]]
    return "-".join(given[n // len(given) ** j % len(given)] for j in range(draw + 1))


def surrogate(key: bytes, kind: str, text: str, draw: int = 0) -> str:
    """The replacement of one original. draw: which one, where earlier ones met another's. kind of a name: name/m,
    name/f or name/n by gender."""
    tweak = f"{kind}/{draw}"
    if kind == "email":
        local, domain = text.rsplit("@", 1)
        name, top = domain.rsplit(".", 1)
        return f"{reshape(key, tweak, local)}@{reshape(key, f'domain/{draw}', name)}.{top}"
    if kind == "ip":
        ip = ipaddress.IPv4Address(".".join(str(int(o)) for o in text.split(".")))
        net = _net(ip)
        base, size = (int(net.network_address), net.num_addresses) if net else (0, 1 << 32)
        while True:
            ip = ipaddress.IPv4Address(base + permute(key, f"{tweak}/{base}", int(ip) - base, size))
            if _net(ip) == net:
                return str(ip)
    if kind == "card":
        d = "".join(filter(str.isdigit, text))
        body = d[0] + reshape(key, f"{tweak}/{d[0]}", d[1:-1])
        return _fill(text, body + str(luhn(body)))
    if kind == "phone":
        head = _HEAD.match(text).group()
        rest = text[len(head) :]
        if m := _INVENTED.fullmatch(rest):
            d = reshape(key, f"{tweak}/555", m[2] + m[5])
            return f"{head}{m[1]}{d[:3]}{m[3]}555{m[4]}{d[3:]}"
        while _INVENTED.fullmatch(rest := reshape(key, tweak, rest)):
            pass
        return head + rest
    if kind == "iban":
        return text[:2] + reshape(key, tweak + text[:2], text[2:])
    if kind == "key":
        head = _PREFIX.match(text).group()
        return head + reshape(key, tweak + head, text[len(head) :])
    if kind == "surname":
        script, n = _script(text), _mac(key, tweak, text, size=16 + draw)
        b, m, e = _BEGIN[script], _MIDDLE[script], _END[script]
        more = "".join(m[n // 1_000_000_007 // len(m) ** j % len(m)] for j in range(draw))
        return b[n % len(b)] + m[n // 97 % len(m)] + m[n // 9973 % len(m)] + more + e[n // 999983 % len(e)]
    if kind.startswith("name/"):
        words = re.split("([ -])", text)
        if len(words) == 1:
            return surrogate(key, "surname", text, draw)
        return _given(key, kind, text, draw) + "".join(w if w in " -" else surrogate(key, "surname", w) for w in words[1:])
    if re.fullmatch("[0-9a-f]+", text):
        return reshape(key, tweak + "/hex", text, ("0123456789abcdef",))
    while re.fullmatch("[0-9a-f]+", text := reshape(key, tweak, text)):
        pass
    return text


def mentions(text: str, known: dict[str, str]) -> Iterator[tuple[int, int]]:
    """Where known names of one to three words stand, the longest at each place; one look at each word."""
    done = 0
    for m in _FIRST.finditer(text):
        if m.start() < done:
            continue
        ends = [m.end()]
        while len(ends) < 3 and (more := _NEXT.match(text, ends[-1])):
            ends.append(more.end())
        for e in reversed(ends):
            if text[m.start() : e] in known and not (text[e : e + 1].isalnum() or text[e : e + 1] == "_"):
                yield m.start(), e
                done = e
                break


def detect(text: str) -> list[tuple[int, int, str]]:
    """(start, stop, kind) of the entities, in order; of overlapping ones the first, then the longest."""
    found: list[tuple[int, int, str]] = []
    if "@" in text:
        found += [(*m.span(), "email") for m in _EMAIL.finditer(text)]
    if any(d in text for d in "0123456789"):
        found += [(*m.span(), "ip") for m in _IP.finditer(text)]
        found += [(*m.span(), "card") for m in _CARD.finditer(text) if is_card(m.group())]
        found += [(*m.span(), "phone") for m in _PHONE.finditer(text)]
        found += [(*m.span(), "ssn") for m in _SSN.finditer(text)]
        found += [(*m.span(), "iban") for m in _IBAN.finditer(text)]
        found += [(*m.span(), "key") for m in _KEY.finditer(text)]
    if "=" in text or ":" in text:
        found += [(*m.span(1), "secret") for m in _SECRET.finditer(text)]
    if names := [(*m.span(2), "name/" + _TITLES[m[1]]) for m in _NAME.finditer(text)]:
        also: dict[str, str] = {}
        for a, b, kind in sorted(names, key=lambda f: f[0] - f[1]):
            for part in (text[a:b], *re.split("[ -]", text[a:b])):
                also.setdefault(part, kind)
        found += names + [(x, y, also[text[x:y]]) for x, y in mentions(text, also)]
    out, end = [], 0
    for a, b, kind in sorted(found, key=lambda f: (f[0], -f[1])):
        if a >= end:
            out.append((a, b, kind))
            end = b
    return out


def canonical(kind: str, text: str) -> str:
    """How an original is compared: addresses without case, and without leading zeros."""
    if kind == "ip":
        return ".".join(str(int(o)) for o in text.split("."))
    return text.lower() if kind == "email" else text


def _drawn(kind: str, original: str) -> list[tuple[str, str]]:
    """What draws apart: of a name each surname, and the full name for its first word."""
    if not kind.startswith("name/"):
        return [(kind, original)]
    words = re.split("[ -]", original)
    return [("surname", w) for w in words[1:] or words] + [(kind, original)] * (len(words) > 1)


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(doc, th, k, v) for doc, th, text in zip(b["doc_id"].to_pylist(), b["th"].to_pylist(), b["text"])
                for k, v in {d for t in [text.as_py()] for x, y, kind in detect(t) for d in _drawn(kind, canonical(kind, t[x:y]))}]
        yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))], names=["doc_id", "th", "kind", "original"])


def _draw(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(b["kind"].to_pylist(), b["original"].to_pylist(), b["draw"].to_pylist())
            made = pa.array([surrogate(key, k, v, n) for k, v, n in rows], pa.string())
            yield pa.record_batch([b["kind"], b["original"], b["place"], b["draw"], made], names=["kind", "original", "place", "draw", "surrogate"])

    return run


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        of = [place(k, v) for k, v in zip(b["kind"].to_pylist(), b["original"].to_pylist())]
        names = pa.array([hashlib.sha256(p.encode("utf-8", "surrogatepass")).hexdigest() if p else None for p, _ in of], pa.string())
        yield pa.record_batch([b["kind"], b["original"], names, pa.array([min(n, 1 << 60) for _, n in of], pa.int64())], names=["kind", "original", "place", "strings"])


def draws(originals: DataFrame, key: bytes, rounds: int | None = None) -> DataFrame:
    """kind, original, draw of the originals whose first surrogate met another's or an original. rounds: an error after
    so many; None: until nothing meets, which each round brings nearer."""
    schema = "kind string, original string, place string, draw int, surrogate string"
    of = cut(originals.select("kind", "original").mapInArrow(frugal(_places), "kind string, original string, place string, strings long"))
    dense = of.where("place is not null").groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.first("strings").alias("m")).where(F.col("n") > F.col("m") / DENSE)
    dense = cut(dense.select("place", "m"))
    small = F.broadcast if dense.count() <= SMALL_IDS else lambda df: df  # a join by place would put one range into one task
    # place: null if not dense, empty for a string that is the only one of its shape
    of = of.join(small(dense), "place", "left").select("kind", "original", F.when(F.col("m") == 1, "").when(F.col("m") > 1, F.col("place")).alias("place"))
    now = cut(of.withColumn("draw", F.lit(0)).select("kind", "original", "place", "draw").mapInArrow(frugal(_draw(key)), schema))
    n = 0
    while rounds is None or n < rounds:
        n += 1
        free = now.where("place is null")
        least = free.groupBy("kind", "surrogate").agg(F.min("original").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
        taken = free.select("kind", F.col("original").alias("surrogate")).distinct().withColumn("taken", F.lit(True))
        own = now.where("place <> '' and surrogate = original").select("place").distinct().withColumn("own", F.lit(True))
        met = now.join(least, ["kind", "surrogate"], "left").join(taken, ["kind", "surrogate"], "left").join(small(own), "place", "left")
        meets = F.coalesce(F.col("taken"), F.lit(False)) | F.coalesce(F.col("original") != F.col("least"), F.lit(False))
        met = met.withColumn("again", F.when(F.col("place").isNull(), meets).otherwise(F.coalesce(F.col("own"), F.lit(False))))
        met = cut(met.select("kind", "original", "place", "draw", "surrogate", "again"))
        if met.where("again").isEmpty():
            return now.where("draw > 0").select("kind", "original", "draw")
        new = met.where("again").select("kind", "original", "place", (F.col("draw") + 1).alias("draw")).mapInArrow(frugal(_draw(key)), schema)
        now = cut(met.where("not again").drop("again").unionAll(new))
    raise ValueError(f"surrogates still meet after {rounds} draws")


def _replace(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple, str] = {}
        for b in batches:
            texts, spans = [], []
            for text, at in zip(b["text"], b["at"]):
                t, again = text.as_py(), {(r["kind"], r["original"]): r["draw"] for r in at.as_py() or []}
                out, mine, done = [], [], 0

                def new(kind: str, v: str, make=surrogate) -> str:
                    what = (make, kind, v, again.get((kind, v), 0))
                    if what not in kept:
                        if len(kept) > 100_000:
                            kept.clear()
                        kept[what] = make(key, *what[1:])
                    return kept[what]

                found = detect(t)
                full = [(kind, t[x:y]) for x, y, kind in found if kind.startswith("name/") and re.search("[ -]", t[x:y])]
                first = {re.split("[ -]", v)[0]: (kind, v) for kind, v in reversed(full)}
                for _, v in full:
                    for w in re.split("[ -]", v)[1:]:
                        first.pop(w, None)
                for x, y, kind in found:
                    v = canonical(kind, t[x:y])
                    if not kind.startswith("name/"):
                        put = new(kind, v)
                    elif v in first:
                        put = new(*first[v], _given)
                    else:
                        words = re.split("([ -])", v)
                        put = new(kind, v, _given) if len(words) > 1 else new("surname", v)
                        put += "".join(w if w in " -" else new("surname", w) for w in words[1:])
                    out += [t[done:x], put]
                    mine.append({"start": x, "stop": y, "kind": kind, "surrogate": put})
                    done = y
                texts.append("".join([*out, t[done:]]))
                spans.append(mine)
            span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string()), ("surrogate", pa.string())]))
            yield pa.record_batch([b["doc_id"], b["th"], b["rest"], pa.array(texts, pa.string()), pa.array(spans, span)], names=["doc_id", "th", "rest", "text", "spans"])

    return run


def key_of(spark: SparkSession) -> bytes:
    """The key that the session is set to."""
    return spark.conf.get(KEY_SETTING, SHOWN_KEY).encode()


def replace_private(docs: DataFrame, key: bytes, rest: list[str] = ()) -> DataFrame:
    """A row for each row of docs: doc_id, th (of the original text), text with surrogates, spans (start and stop in
    the original, kind, surrogate), and rest: a struct of the named other columns. key: what surrogates are drawn by; who
    has it can tell whether a surrogate may be that of a known original."""
    if not key:
        raise ValueError("surrogates need a key")
    d = keyed(docs)
    mentions = cut(d.mapInArrow(frugal(_mentions), "doc_id long, th long, kind string, original string"))
    again = cut(draws(mentions.select("kind", "original").distinct(), key))
    lists = mentions.join(again, ["kind", "original"]).groupBy("doc_id", "th").agg(F.collect_list(F.struct("kind", "original", "draw")).alias("at"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    full = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"), F.struct(F.lit(True).alias("_"), *rest).alias("rest"))
    long, string = T.LongType(), T.StringType()
    span = T.StructType([T.StructField(n, t) for n, t in (("start", T.IntegerType()), ("stop", T.IntegerType()), ("kind", string), ("surrogate", string))])
    schema = T.StructType([T.StructField(n, t) for n, t in (("doc_id", long), ("th", long), ("rest", full.schema["rest"].dataType), ("text", string), ("spans", T.ArrayType(span)))])
    return with_lists(full, cut(lists), 64, "left").mapInArrow(frugal(_replace(key)), schema)


def op10_surrogates(spark, sf_dir: str) -> DataFrame:
    out = replace_private(load(spark, sf_dir, "documents"), key_of(spark))
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform("spans", lambda s: F.split_part(s["kind"], F.lit("/"), F.lit(1))))), ",")
    return out.select("doc_id", F.size("spans").cast("long").alias("n_entities"), kinds.alias("kinds"), "text")
