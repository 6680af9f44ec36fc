"""Language identification with interpolated Kneser-Ney character models."""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoscope.llm.common import crc_fold, held_out, mix64, shared_dir, stored

#: Characters of the longest n-gram; a code holds four UTF-16 units in 64 bits.
ORDER = 4
DISCOUNT = 0.75
#: Bytes of one file of a model, and how many of them a worker holds open; a model has as many files as it needs.
FILE_BYTES, OPEN_FILES = 1 << 22, 32
#: Share of its calibration documents whose cross-entropy a language accepts.
ACCEPTED = 0.995
UNITS = 1 << 18
UNKNOWN = "und"

_U = np.uint64


def _classes() -> np.ndarray:
    """Per UTF-16 unit what it counts as: letters (and surrogates) as their small letter, all else as blank."""
    out = np.full(1 << 16, 32, np.uint64)
    for u in range(1 << 16):
        c = chr(u)
        if 0xD800 <= u < 0xE000:
            out[u] = u
        elif c.isalpha():
            small = c.lower()
            out[u] = ord(small) if len(small) == 1 else u
    return out


_CLASS: list[np.ndarray] = []


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all characters with the three before them, and per text where its codes start (one more at the end).

    A text is its letters in words parted by one blank, with three blanks before
    and one after, so a text without letters has the code of one blank run only.
    """
    if not _CLASS:
        _CLASS.append(_classes())
    pieces, ends = [], [0]
    lead = np.full(3, 32, _U)
    for text in texts:
        raw = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)
        units = _CLASS[0][raw]
        blank = units == 32
        keep = ~blank
        keep[1:] |= ~blank[:-1]
        units = units[keep]
        if len(units) and units[0] == 32:
            units = units[1:]
        if len(units) and units[-1] != 32:
            units = np.append(units, _U(32))
        pieces += [lead, units]
        ends.append(ends[-1] + len(units))
    flat = np.concatenate(pieces) if pieces else np.zeros(0, _U)
    codes = flat.copy()
    for back in (1, 2, 3):
        codes[back:] |= flat[:-back] << _U(16 * back)
    ends = np.array(ends)
    skip = np.zeros(len(flat), bool)
    at = ends[:-1] + 3 * np.arange(len(texts))
    for k in range(3):
        skip[at + k] = True
    return codes[~skip], ends


def _batches(column: pa.Array, limit: int = UNITS) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``limit`` characters, with the index of the first."""
    texts = column.fill_null("").to_pylist()
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= limit):
            size += len(texts[end])
            end += 1
        yield at, texts[at:end]
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of n-gram codes by language, of everything a batch holds."""
    for batch in batches:
        languages = batch.column("lang").dictionary_encode()
        names, of = languages.dictionary.to_pylist(), languages.indices.to_numpy()
        seen: dict[str, list] = {n: [] for n in names}
        for at, texts in _batches(batch.column("text")):
            codes, ends = grams(texts)
            owner = np.repeat(of[at : at + len(texts)], np.diff(ends))
            for k, name in enumerate(names):
                mine = codes[owner == k]
                if len(mine):
                    seen[name].append(np.unique(mine, return_counts=True))
        for name, parts in seen.items():
            if not parts:
                continue
            values, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            counts = np.bincount(back, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(values), pa.string()), pa.array(values.view(np.int64)), pa.array(counts)],
                names=["lang", "code", "n"],
            )


@dataclass
class Tables:
    """Sorted hash arrays of all languages' n-grams and contexts, one row of log values per language.

    ``grams[k]``: hashes and log2 P(last character | those before) of n-grams of k + 1
    characters that any language has; ``backs[k]``: hashes and log2 weight left to
    the next lower order of contexts of k characters.
    """

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    backs: list[tuple[np.ndarray, np.ndarray]]
    floor: np.ndarray

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """log2 P of each code's last character by language."""
        out = np.zeros((len(codes), len(self.languages)), np.float32)
        todo = np.arange(len(codes))
        for k in range(ORDER - 1, -1, -1):
            part = _suffix(codes[todo], k + 1)
            found, at = _find(self.grams[k][0], _hashed(part, k + 1))
            out[todo[found]] += self.grams[k][1][at]
            todo, part = todo[~found], part[~found]
            if not len(todo):
                return out
            if k:
                found, at = _find(self.backs[k][0], _hashed(part >> _U(16), k))
                out[todo[found]] += self.backs[k][1][at]
        out[todo] += self.floor
        return out


def _suffix(codes: np.ndarray, n: int) -> np.ndarray:
    return codes if n == 4 else codes & _U((1 << (16 * n)) - 1)


def _hashed(codes: np.ndarray, n: int) -> np.ndarray:
    return mix64(codes + _U(n * 0x9E3779B97F4A7C15 % (1 << 64)))


def _find(table: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(hashes), bool), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    found = table[at] == hashes
    return found, at[found]


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang, code, n`` over all rows of ``lang, text``; n-grams are combined by batch before the shuffle."""
    return docs.mapInArrow(_count, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def _wide(rows: DataFrame, key: str, value, languages: list[str], missing: float) -> DataFrame:
    """``key, values``: an array of one value per language; a language has at most one row of a key."""
    by_name = F.map_from_entries(F.collect_list(F.struct("lang", value)))
    names = F.array(*[F.lit(x) for x in languages])
    return rows.groupBy(key).agg(by_name.alias("_m")).select(
        key, F.transform(names, lambda x: F.coalesce(F.try_element_at("_m", x), F.lit(missing))).alias("values")
    )


def _product(a: str, b: str):
    return F.zip_with(a, b, lambda x, y: x * y)


def model_levels(counts: DataFrame, languages: list[str], discount: float = DISCOUNT) -> tuple[list[tuple[int, DataFrame]], np.ndarray]:
    """Probabilities of all counted n-grams as ``(kind, rows of code, values)``, and the floor of each language.

    Kind k holds P(last character | those before) of n-grams of k characters and kind -k the
    weight that contexts of k characters leave to the next lower order, each with one value per
    language. The longest n-grams count how often they occur, lower ones how many different
    characters stand before them. Every order is joined to the next lower one, so nothing but a value per language
    comes to the driver.
    """
    levels = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        levels[k] = stored(
            levels[k + 1].groupBy("lang", F.expr(f"code & {(1 << (16 * k)) - 1}L").alias("code")).agg(F.count(F.lit(1)).alias("n")),
            "language",
        )
    context = F.shiftrightunsigned("code", 16)
    kinds, floor, lower = [], np.zeros(len(languages)), None
    for k in range(1, ORDER + 1):
        totals = levels[k].groupBy("lang", context.alias("context")).agg(
            F.sum("n").alias("total"), F.sum(F.greatest(F.col("n") - discount, F.lit(0.0))).alias("used")
        )
        left = _wide(totals, "context", 1 - F.col("used") / F.col("total"), languages, 1.0)
        shares = levels[k].withColumn("context", context).join(totals, ["lang", "context"])
        own = _wide(shares, "code", F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("total"), languages, 0.0)
        if lower is None:
            alphabet = levels[1].agg(F.count_distinct("code")).first()[0] + 1  # and one for all that was never seen
            free = np.array(left.first()["values"]) / alphabet  # the only context: a value per language
            floor = np.log2(free)
            rest = F.array(*[F.lit(float(x)) for x in free])
            rows = own.select("code", F.zip_with("values", rest, lambda x, y: x + y).alias("values"))
        else:
            left = stored(left, "language")
            kinds.append((1 - k, left.withColumnRenamed("context", "code")))
            below = lower.select(F.col("code").alias("suffix"), F.col("values").alias("below"))
            rows = (
                own.withColumn("context", context).withColumn("suffix", F.expr(f"code & {(1 << (16 * (k - 1))) - 1}L"))
                .join(left.withColumnRenamed("values", "left"), "context").join(below, "suffix")
                .select("code", F.zip_with("values", _product("left", "below"), lambda x, y: x + y).alias("values"))
            )
        lower = stored(rows, "language")
        kinds.append((k, lower))
    return kinds, floor


def _write_model(base: str, width: int):
    """Files of sorted codes and their values, each of one kind; a row per file comes out."""
    most = max(1, FILE_BYTES // (8 + 4 * width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(base)
        store.create_dir(folder)
        schema = pa.schema([("code", pa.int64()), ("values", pa.list_(pa.float32(), width))])
        done, codes, values, held, kind = [], [], [], 0, None

        def flush():
            nonlocal codes, values, held
            if held:
                code = np.concatenate(codes)
                row = pa.RecordBatch.from_arrays(
                    [pa.array(code), pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(values)), width)], schema=schema
                )
                # Only files of attempts that succeeded are in the list, so each attempt's have names of their own.
                path = f"{folder}/{uuid.uuid4().hex}"
                with store.open_output_stream(path) as sink, pa.ipc.new_file(sink, schema) as file:
                    file.write_batch(row)
                done.append((kind, int(code[0]), path))
            codes, values, held = [], [], 0

        for batch in batches:
            of = batch.column("kind").to_numpy()
            code = batch.column("code").to_numpy()
            value = batch.column("values").flatten().to_numpy().astype(np.float32)
            cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                if of[begin] != kind:
                    flush()
                    kind = int(of[begin])
                while begin < end:
                    upto = min(end, begin + most - held)
                    codes.append(code[begin:upto])
                    values.append(value[begin * width : upto * width])
                    held += upto - begin
                    begin = upto
                    if held == most:
                        flush()
        flush()
        columns = list(zip(*done)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.string()))], names=["kind", "first", "path"]
        )

    return run


class Model:
    """All languages' n-grams in files of the shared folder, found by the first code of each file.

    Only the list of the files travels to the workers. They map the files where the folder is a mounted one and
    otherwise read them whole, at most ``OPEN_FILES`` at a time.
    """

    def __init__(self, languages: list[str], floor: np.ndarray, base: str, files: list[tuple[int, int, str]]):
        self.languages, self.floor, self.base = languages, floor, base
        self.files = {}
        for kind in {f[0] for f in files}:
            mine = sorted(f[1:] for f in files if f[0] == kind)
            self.files[kind] = np.array([f[0] for f in mine], np.int64), [f[1] for f in mine]
        self._open: OrderedDict | None = None

    def __getstate__(self):
        return self.__dict__ | {"_open": None}

    def _read(self, path: str) -> tuple[np.ndarray, np.ndarray]:
        if self._open is None:
            self._open = OrderedDict()
        if path in self._open:
            self._open.move_to_end(path)
            return self._open[path]
        store, _ = fs.FileSystem.from_uri(self.base)
        if isinstance(store, fs.LocalFileSystem):
            store = fs.LocalFileSystem(use_mmap=True)
        batch = pa.ipc.open_file(store.open_input_file(path)).get_batch(0)
        found = batch.column(0).to_numpy(), batch.column(1).flatten().to_numpy().reshape(-1, len(self.languages))
        self._open[path] = found
        if len(self._open) > OPEN_FILES:
            self._open.popitem(last=False)
        return found

    def _find(self, kind: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the codes have a row, and the rows of those, as log2."""
        firsts, paths = self.files.get(kind, (np.zeros(0, np.int64), []))
        wanted, back = np.unique(codes.view(np.int64), return_inverse=True)
        hit, row = np.zeros(len(wanted), bool), np.zeros((len(wanted), len(self.languages)), np.float32)
        which = np.searchsorted(firsts, wanted, side="right") - 1
        for f in np.unique(which[which >= 0]).tolist():
            lo, hi = np.searchsorted(which, [f, f + 1])
            table, rows = self._read(paths[f])
            at = np.minimum(np.searchsorted(table, wanted[lo:hi]), len(table) - 1)
            hit[lo:hi] = table[at] == wanted[lo:hi]
            row[lo:hi] = rows[at]
        found, values = hit[back], row[back]
        return found, values[found]

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """log2 P of each code's last character by language."""
        if not self.languages:
            return np.zeros((len(codes), 0), np.float32)
        wanted, back = np.unique(codes, return_inverse=True)
        out = np.zeros((len(wanted), len(self.languages)), np.float32)
        todo = np.arange(len(wanted))
        for k in range(ORDER, 0, -1):
            part = _suffix(wanted[todo], k)
            found, rows = self._find(k, part)
            out[todo[found]] += rows
            todo, part = todo[~found], part[~found]
            if not len(todo):
                return out[back]
            if k > 1:
                found, rows = self._find(1 - k, part >> _U(16))
                out[todo[found]] += rows
        out[todo] += self.floor
        return out[back]


def learn(counts: DataFrame) -> Model:
    """Interpolated Kneser-Ney models of all languages of ``lang, code, n``, from every n-gram that was counted."""
    spark = counts.sparkSession
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    base = f"{shared_dir(spark).rstrip('/')}/language-model-{uuid.uuid4().hex}"
    if not languages:
        return Model([], np.zeros(0), base, [])
    kinds, floor = model_levels(counts, languages)
    rows = None
    for kind, level in kinds:
        part = level.select(F.lit(kind).alias("kind"), "code", F.transform("values", lambda x: F.log2(x).cast("float")).alias("values"))
        rows = part if rows is None else rows.union(part)
    dealt = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "kind", "code").sortWithinPartitions("kind", "code")
    # A row per file of FILE_BYTES.
    files = dealt.mapInArrow(_write_model(base, len(languages)), "kind int, first bigint, path string").collect()
    return Model(languages, floor, base, [(r["kind"], r["first"], r["path"]) for r in files])


def build_tables(rows: dict[str, np.ndarray], discount: float = DISCOUNT) -> Tables:
    """The models of :func:`learn` in memory, from columns ``lang, n_chars, code, n, total``; tests hold the files against it."""
    names = sorted(set(rows["lang"].tolist()))
    number = {n: i for i, n in enumerate(names)}
    lang = np.array([number[x] for x in rows["lang"].tolist()], np.int64)
    codes, n, total = rows["code"].astype(np.int64).view(_U), rows["n"].astype(float), rows["total"].astype(float)
    width = len(names)
    tables = Tables(names, [], [(np.zeros(0, _U), np.zeros((0, width), np.float32))], np.zeros(width))
    lowest = codes[rows["n_chars"] == 1]
    alphabet = len(np.unique(lowest)) + 1  # and one for all that was never seen
    uniform = 1 / alphabet
    lower = None
    for k in range(1, ORDER + 1):
        mine = rows["n_chars"] == k
        code, of, c, t = codes[mine], lang[mine], n[mine], total[mine]
        context = code >> _U(16)
        # Weight that discounting and left-out rows free in each context.
        contexts, at = np.unique(context, return_inverse=True)
        used, whole = np.zeros((len(contexts), width)), np.zeros((len(contexts), width))
        np.add.at(used, (at, of), np.maximum(c - discount, 0))
        whole[at, of] = t
        left = np.where(whole > 0, 1 - used / np.maximum(whole, 1), 1.0)
        grams_, where = np.unique(code, return_inverse=True)
        own = np.zeros((len(grams_), width))
        own[where, of] = np.maximum(c - discount, 0) / t
        if lower is None:
            below = np.full((len(grams_), width), uniform)
            tables.floor = np.log2(left[0] * uniform) if len(left) else np.full(width, np.log2(uniform))
        else:
            below = 2.0 ** lower(grams_)
        p = own + left[np.searchsorted(contexts, grams_ >> _U(16))] * below
        hashes = _hashed(grams_, k)
        order = np.argsort(hashes)
        tables.grams.append((hashes[order], np.log2(p[order]).astype(np.float32)))
        if k > 1:
            hashes = _hashed(contexts, k - 1)
            order = np.argsort(hashes)
            tables.backs.append((hashes[order], np.log2(left[order]).astype(np.float32)))

        def lower(at_codes, tables=tables, k=k):
            """log2 P of the codes' last characters by order k and below."""
            out = np.zeros((len(at_codes), width))
            todo = np.arange(len(at_codes))
            for j in range(k - 1, -1, -1):
                part = _suffix(at_codes[todo], j + 1)
                found, at = _find(tables.grams[j][0], _hashed(part, j + 1))
                out[todo[found]] += tables.grams[j][1][at]
                todo, part = todo[~found], part[~found]
                if not len(todo):
                    return out
                if j:
                    found, at = _find(tables.backs[j][0], _hashed(part >> _U(16), j))
                    out[todo[found]] += tables.backs[j][1][at]
            out[todo] += tables.floor
            return out

    return tables


@dataclass
class Calibration:
    """Cross-entropy up to which a language accepts a text, and the probability of a margin."""

    accepted: dict[str, float]
    slope: float
    shift: float


def _entropies(tables: Tables | Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bits per character by text and language, and the number of characters."""
    codes, ends = grams(texts)
    sizes = np.diff(ends)
    total = np.zeros((len(texts), len(tables.languages)))
    live = np.flatnonzero(sizes)
    if len(live):
        total[live] = np.add.reduceat(tables.log_probabilities(codes).astype(np.float64), ends[:-1][live], axis=0)
    return -total / np.maximum(sizes, 1)[:, None], sizes


def _predict(shared, calibration: Calibration | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: Model = shared.value
        names = np.array([*tables.languages, UNKNOWN], object)
        for batch in batches:
            best, entropy, margin, size = [], [], [], []
            for _, texts in _batches(batch.column("_text")):
                h, n = _entropies(tables, texts)
                if not tables.languages:
                    h = np.zeros((len(texts), 1))
                order = np.sort(h, axis=1)
                best.append(np.where(n > 0, h.argmin(axis=1), -1) if tables.languages else np.full(len(texts), -1))
                entropy.append(order[:, 0])
                margin.append(order[:, min(1, h.shape[1] - 1)] - order[:, 0])
                size.append(n)
            cat = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
            best, entropy, margin, size = cat(best, int), cat(entropy, float), cat(margin, float), cat(size, int)
            lang = names[best]
            columns = [pa.array(lang.tolist(), pa.string()), pa.array(entropy), pa.array(margin), pa.array(size, pa.int64())]
            if calibration is not None:
                # Evidence grows with the margin and the square root of the length.
                x = margin * np.sqrt(np.minimum(size, 1 << 20))
                score = np.where(best < 0, 0.0, 1 / (1 + np.exp(-np.clip(calibration.slope * x + calibration.shift, -500, 500))))
                limit = np.array([calibration.accepted.get(v, np.inf) for v in lang])
                columns += [pa.array(score), pa.array((best < 0) | (entropy > limit))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *columns],
                names=[*batch.schema.names[:-1], "lang_pred", "entropy", "margin", "n_units", *(["score", "rejected"] if calibration else [])],
            )

    return run


_SCORED = "lang_pred string, entropy double, margin double, n_units bigint"


def _fit_calibration(tried: DataFrame) -> Calibration:
    """From the calibration fold's predictions: quantiles by language, and a logistic curve on bins of the margin."""
    x = F.least(F.col("margin") * F.sqrt(F.least(F.col("n_units"), F.lit(1 << 20))), F.lit(100.0))
    right = (F.col("lang") == F.col("lang_pred")).cast("bigint")
    # At most 400 bins and a row per language come to the driver.
    bins = tried.groupBy(F.floor(x * 4).alias("bin")).agg(F.avg(x).alias("x"), F.sum(right).alias("right"), F.count(F.lit(1)).alias("n")).collect()
    limits = tried.filter("lang = lang_pred").groupBy("lang_pred").agg(
        F.percentile_approx("entropy", ACCEPTED, 10_000).alias("limit")
    ).collect()
    theta = np.array([1.0, 0.0])
    if bins:
        xs, hits, n = (np.array([float(b[c]) for b in bins]) for c in ("x", "right", "n"))
        design = np.column_stack([xs, np.ones(len(xs))])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
            g = design.T @ (hits - n * p) - 1e-2 * (theta - [1.0, 0.0])
            h = design.T @ (design * (n * p * (1 - p))[:, None]) + 1e-2 * np.eye(2)
            theta = theta + np.clip(np.linalg.solve(h, g), -1, 1)
    return Calibration({r["lang_pred"]: float(r["limit"]) for r in limits}, max(float(theta[0]), 1e-3), float(theta[1]))


def identify(docs: DataFrame, training: DataFrame, fold=None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred, entropy, margin, n_units, score, rejected`` to every document.

    ``training`` has ``lang`` and ``text``; rows where the boolean column ``fold``
    is true calibrate and the others are counted, all of them. Each language's model is an interpolated Kneser-Ney model
    of four characters; the language with the fewest bits per character wins, in
    equal cases the first by name. ``score`` is the calibrated probability that it is right;
    ``rejected`` says that its bits exceed what nearly all calibration
    texts of that language need (texts without letters are always rejected).

    Null texts and texts without letters get ``und`` and score 0; so do all texts
    when nothing was learned. Training rows with a null text or language are left
    out. Existing columns of the new names are replaced; an empty table gives no
    rows.
    """
    spark = docs.sparkSession
    calibrating = F.lit(False) if fold is None else fold
    useful = training.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("_fold", calibrating)
    counts = stored(gram_counts(useful.filter(~F.col("_fold")).select("lang", "text")), "language")
    shared = spark.sparkContext.broadcast(learn(counts))
    sample = useful.filter("_fold").select("lang", F.col("text").alias("_text"))
    tried = stored(sample.mapInArrow(_predict(shared, None), f"lang string, {_SCORED}").filter(f"lang_pred <> '{UNKNOWN}'"), "language")
    calibration = _fit_calibration(tried)
    made = ("lang_pred", "entropy", "margin", "n_units", "score", "rejected", "_text")
    own = [c for c in (docs.columns if keep is None else keep) if c not in made]
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in own), _SCORED, "score double, rejected boolean"])
    # Letters beyond the first plane count by their surrogates; other such signs do not.
    body = F.when(F.col(text).rlike(r"\p{L}"), F.col(text)).otherwise("")
    return docs.select(*own, body.alias("_text")).mapInArrow(_predict(shared, calibration), schema)


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    training = docs.filter(~held_out(F.col("doc_id")))
    thin = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    found = identify(thin, training, crc_fold(F.col("doc_id")) == 1, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "entropy", "margin", "rejected")
