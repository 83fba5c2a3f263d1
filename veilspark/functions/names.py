"""File names carry data: interface, study, hypothesis, dataset, page, total and date."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# IF_DL_<interface>_<study>_<hypothesis>_<dataset>_<page>_<total>_<date...>.txt (fixed format)
FILE_NAME = (
    r"^IF_DL_(\d{3})_(\d{4})([0-9A-Za-z]{5})_([A-Z]\d{4})_(.+)_(\d+)_(\d+)_(\d{8})\d*\.txt$"
)

# Interface numbers of the providers, per kind of file (fixed values).
KEY_INTERFACES = {"K0001": "301", "K0002": "302", "K0003": "303"}
DATA_INTERFACES = {"K0001": "501", "K0002": "502", "K0003": "503"}
LAST_PROVIDER = "K0004"


def _number(provider: Column, numbers: dict[str, str], last: str, otherwise: str) -> Column:
    chain = F.when(provider == LAST_PROVIDER, last)
    for code, number in numbers.items():
        chain = chain.when(provider == code, number)
    return chain.otherwise(otherwise)


def interface_number(provider: Column, stage: str) -> Column:
    """Three digits: 301-304 for keys, 501-504 for data, 801/802 for de-identified data.

    An unknown provider counts as the last one; de-identified files go by the centre
    that asked, 801 for the first provider and 802 for any other.
    """
    if stage == "key":
        return _number(provider, KEY_INTERFACES, "304", "304")
    if stage == "data":
        return _number(provider, DATA_INTERFACES, "504", "504")
    if stage == "deid":
        return F.when(provider == "K0001", "801").otherwise("802")
    raise ValueError(f"unknown stage {stage!r}")


def interface_id(provider: Column, stage: str) -> Column:
    """`IF_DL_` and the interface number."""
    return F.concat(F.lit("IF_DL_"), interface_number(provider, stage))


def data_interface(provider: Column, otherwise: str) -> Column:
    """Interface id of a data file, with the number to use for an unknown provider."""
    return F.concat(F.lit("IF_DL_"), _number(provider, DATA_INTERFACES, "504", otherwise))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once per row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def parse_file_name(name: Column) -> Column:
    """Struct of the parts of a data file name; null where the name has another form.

    The pattern is matched once per name: its groups are put side by side and split.
    """
    groups = F.split(F.regexp_replace(name, FILE_NAME, "$1\n$2-$3\n$4\n$5\n$6\n$7\n$8"), "\n")
    return _with(
        groups,
        lambda group: F.when(
            F.size(group) == 7,
            F.struct(
                group[0].alias("interface"),
                group[1].alias("ask_id"),
                group[2].alias("rshp_id"),
                group[3].alias("cat_cd"),
                group[4].try_cast("int").alias("page"),
                group[5].try_cast("int").alias("total"),
                group[6].alias("ymd"),
            ),
        ),
    )


def output_name(
    name: Column,
    stage: str,
    provider: Column,
    dataset: Column,
    exec_seq: Column | None = None,
) -> Column:
    """Name of the file that a stage makes from a delivered file.

    `key` puts the key interface in front. `provider` sets the dataset and cuts the
    date to eight digits. `original` changes nothing. `deid` also sets the interface
    of the centre. `summary` and `deid_summary` mark a summary with `S`, the latter
    with the run number behind it. Names of another form give null.
    """
    if stage == "original":
        return name
    if stage == "key":
        return F.concat(interface_id(provider, "key"), F.lit("_"), name)
    marks: list[Column] = []
    interface = None
    if stage == "provider":
        pass
    elif stage == "deid":
        interface = interface_number(provider, "deid")
    elif stage == "summary":
        interface, marks = interface_number(provider, "data"), [F.lit("S")]
    elif stage == "deid_summary":
        if exec_seq is None:
            raise ValueError("a de-identified summary is named after its run: pass exec_seq")
        interface, marks = interface_number(provider, "deid"), [F.lit("S"), exec_seq.cast("string")]
    else:
        raise ValueError(f"unknown stage {stage!r}")

    def joined(parts: Column) -> Column:
        pieces = [
            F.lit("IF_DL"),
            parts["interface"] if interface is None else interface,
            F.replace(parts["ask_id"], F.lit("-"), F.lit("")),
            parts["rshp_id"],
            dataset,
            *marks,
            parts["page"].cast("string"),
            parts["total"].cast("string"),
            F.concat(parts["ymd"], F.lit(".txt")),
        ]
        return F.when(parts.isNotNull(), F.concat_ws("_", *pieces))

    return _with(parse_file_name(name), joined)


def dash_study(study: Column) -> Column:
    """`201900001` as `2019-00001`."""
    return F.concat(study.substr(1, 4), F.lit("-"), study.substr(5, 5))


def split_packed_key(packed: Column, dashed: bool) -> dict[str, Column]:
    """Study, hypothesis, provider and hash out of one fixed-width field.

    The study takes ten characters when it is `dashed`, else nine, and the dash is
    put in.
    """
    width = 10 if dashed else 9
    study = packed.substr(1, width)
    return {
        "ask_id": study if dashed else dash_study(study),
        "rshp_id": packed.substr(width + 1, 5),
        "prvdr_cd": packed.substr(width + 6, 5),
        "hash_did": packed.substr(width + 11, 64),
    }
