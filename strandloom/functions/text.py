"""Column expressions on attribute strings, product names and hit lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The product of a feature without one, and the shape of an enzyme number.
NO_PRODUCT = "hypothetical protein"
EC = r"[1-7](?:\.(?:[0-9]+|-|n[0-9]+)){3}"


def attributes(c: Column) -> Column:
    """Column nine of a feature line as a map of lists, in either of its two spellings.

    ``key=a,b;...`` or ``key "a"; ...``; the last of repeated keys wins; tokens without a value are
    left out; null gives an empty map.
    """
    tokens = F.transform(F.split(F.coalesce(c, F.lit("")), r";(?=(?:[^\"]*\"[^\"]*\")*[^\"]*$)"), lambda t: F.btrim(t))
    good = F.filter(tokens, lambda t: t.rlike(r"^[^=\s]+(=|\s+\")"))

    def entry(t: Column) -> Column:
        gff3 = t.rlike(r"^[^=\s]+=")
        key = F.when(gff3, F.regexp_extract(t, r"^([^=]+)=", 1)).otherwise(F.regexp_extract(t, r"^(\S+)", 1))
        value = F.when(gff3, F.split(F.regexp_extract(t, r"^[^=]+=(.*)$", 1), ",")).otherwise(F.array(F.regexp_extract(t, r"\"([^\"]*)\"", 1)))
        return F.struct(key.alias("key"), value.alias("value"))

    entries = F.transform(good, entry)
    n = F.size(entries)
    last = F.filter(entries, lambda x, i: ~F.exists(F.slice(entries, i + 2, n), lambda y: y["key"] == x["key"]))
    return F.map_from_entries(last)


def clean_product(c: Column) -> Column:
    """A product name without database fields and without the mark of a fragment."""
    cut = F.substring_index(c, " OS=", 1)
    plain = F.btrim(F.replace(F.replace(cut, F.lit(" (Fragment)"), F.lit("")), F.lit("(Fragment)"), F.lit("")))
    return F.when(plain == "", NO_PRODUCT).otherwise(plain)


def enzyme_numbers(c: Column) -> Column:
    """The different enzyme numbers of ``[EC:...]`` in a description, in order."""
    inside = F.regexp_extract(c, r"\[EC:([^\]]*)\]", 1)
    return F.array_distinct(F.filter(F.split(inside, r"[\s,]+"), lambda x: x.rlike(f"^{EC}$")))


def without_version(c: Column, name: Column) -> Column:
    """An accession without its version; the name where there is none."""
    return F.coalesce(F.nullif(F.regexp_replace(c, r"\.[0-9]+$", ""), F.lit("")), name)


def moved_notes(dbxref: Column, note: Column, prefix: str = "KEGG:") -> Column:
    """(``dbxref``, ``note``): cross references with ``prefix`` go to the end of the notes; empty lists become null."""
    refs = F.coalesce(dbxref, F.array().cast("array<string>"))
    mine, rest = F.filter(refs, lambda x: x.startswith(prefix)), F.filter(refs, lambda x: ~x.startswith(prefix))
    notes = F.concat(F.coalesce(note, F.array().cast("array<string>")), mine)
    return F.struct(F.when(F.size(rest) > 0, rest).alias("dbxref"), F.when(F.size(notes) > 0, notes).alias("note"))
