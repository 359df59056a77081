"""Column functions. All are built from Spark's own expressions and stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the data model.
NOT_SUBMITTED = -2
SUBMITTED = -1
PASS_GRADE = 18
DATA_OP = 0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- JSON -----------------------------------------------------------------------------


def json_field(payload: Column | str, path: str, kind: str = "string") -> Column:
    """Field of a JSON text; null where the field is missing or not of the wanted type."""
    return F.get_json_object(_col(payload), f"$.{path}").try_cast(kind)


def json_object(fields: Sequence[Column | str], names: Sequence[str]) -> Column:
    """One JSON object per row with the given member names."""
    return F.to_json(F.struct(*[_col(c).alias(n) for c, n in zip(fields, names, strict=True)]))


def keyed_json(df: DataFrame, groups: Sequence[str], key: str, fields: dict[str, str]) -> DataFrame:
    """Per group one JSON object whose members are the rows, named by ``key``.

    Meant for groups that are a response to one reader (the courses of one student); the
    rows of one group end up in one value.
    """
    entry = F.struct(
        _col(key).cast("string").alias("key"),
        F.struct(*[F.col(src).alias(label) for label, src in fields.items()]).alias("value"),
    )
    return df.groupBy(*groups).agg(
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("json")
    )


def flatten_payload(df: DataFrame, column: str) -> DataFrame:
    """Fields of a struct column as top-level columns."""
    return df.select(f"{column}.*")


# -- text -----------------------------------------------------------------------------


def split_fields(text: Column | str, names: Sequence[str], sep: str = ",") -> list[Column]:
    """Positional fields of a separated text; missing fields are null, extra ones ignored."""
    parts = F.split(_col(text), sep, -1)
    return [F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)]


def join_fields(*columns: Column | str, sep: str = ",") -> Column:
    return F.concat_ws(sep, *[_col(c).cast("string") for c in columns])


def _title_letters() -> dict[str, str]:
    """Letters whose title case is not their upper case: digraphs (the first part is raised), and
    letters without a single upper case letter, which stay unless they have a title case."""
    letters = [c for c in map(chr, range(1 << 16)) if c.isalpha()]
    odd = [c for c in letters if len(c.upper()) > 1 or c.title() != c.upper()]
    return {c: c.title() if len(c.title()) == 1 else c for c in odd}


_TITLES = _title_letters()


def title_case(text: Column | str) -> Column:
    """First letter of every word in title case; the rest of the word stays as it is."""
    words = F.split(_col(text), r"\s", -1)
    odd, titles = "".join(_TITLES), "".join(_TITLES.values())

    def raised(word: Column) -> Column:
        first = F.substring(word, 1, 1)
        title = F.when(F.contains(F.lit(odd), first), F.translate(first, odd, titles)).otherwise(F.upper(first))
        return F.concat(title, F.substring(word, 2, 2**31 - 1))

    return F.trim(F.array_join(F.transform(words, raised), " "))


def parse_bool(text: Column | str) -> Column:
    """'true' in any case is true; every other text is false."""
    return F.coalesce(F.lower(_col(text)) == "true", F.lit(False))


def same_key(a: Column | str, b: Column | str) -> Column:
    return F.lower(_col(a)) == F.lower(_col(b))


# -- time -----------------------------------------------------------------------------


def iso_timestamp(ts: Column | str) -> Column:
    """ISO local date-time text with microseconds."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def window_start(w: Column | str) -> Column:
    return _col(w).getField("start")


def window_end(w: Column | str) -> Column:
    return _col(w).getField("end")


# -- numbers --------------------------------------------------------------------------


def percent_change(first: Column | str, last: Column | str) -> Column:
    """(last - first) / first * 100; null where ``first`` is zero."""
    return F.try_divide(_col(last) - _col(first), _col(first)) * 100


def distance3(a: Sequence[Column | str], b: Sequence[Column | str]) -> Column:
    """Euclidean distance of two points given by three columns each."""
    dx, dy, dz = (_col(p) - _col(q) for p, q in zip(a, b, strict=True))
    return F.sqrt(dx * dx + dy * dy + dz * dz)


def slice_of(position: Column | str, edge: float, n: int) -> Column:
    """Number of the slice of an axis of length ``edge`` cut into ``n`` equal slices."""
    return F.floor(_col(position) / F.lit(edge / n)).cast("int")


def clamp_reflect(
    position: Column | str, speed: Column | str, low: float, high: float, inset: float = 0.0
) -> tuple[Column, Column]:
    """Position held inside [low, high] and the speed turned round on a crossed border.

    A position at or above ``high`` is put to ``high - inset``.
    """
    p, v = _col(position), _col(speed)
    crossed = (p >= high) | (p <= low)
    held = F.when(p >= high, F.lit(high - inset)).when(p <= low, F.lit(low)).otherwise(p)
    return held, F.when(crossed, -v).otherwise(v)


# -- roles, votes ---------------------------------------------------------------------


def classify_role(role: Column | str, at: str = "state") -> Column:
    """Role a stored user gets (``at='state'``) or a newly registered one (``'register'``)."""
    r = _col(role)
    professor = F.when(r == "PROFESSOR", F.lit("PROFESSOR"))
    if at == "state":
        return professor.when(r == "STUDENT", F.lit("STUDENT")).otherwise(F.lit("ADMIN"))
    if at == "register":
        return professor.otherwise(F.lit("STUDENT"))
    raise ValueError(f"unknown stage {at!r}")


def vote_status(vote: Column | str) -> Column:
    v = _col(vote)
    return (
        F.when(v == NOT_SUBMITTED, F.lit("not submitted"))
        .when(v == SUBMITTED, F.lit("awaiting evaluation"))
        .otherwise(F.concat(F.lit("rating: "), v.cast("string")))
    )


# -- sets -----------------------------------------------------------------------------


def is_subset(a: Column | str, b: Column | str) -> Column:
    return F.size(F.array_except(_col(a), _col(b))) == 0


def missing_members(a: Column | str, b: Column | str) -> Column:
    return F.array_except(_col(a), _col(b))
