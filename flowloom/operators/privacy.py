"""Pseudonyms and identity resolution.

Identifiers come from a keyed hash of the lower-cased name, so any task can
compute them and concurrent runs agree; the dictionary keeps older, random
identifiers valid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions import login_of, normalize_user, sector_path
from flowloom.operators.joining import anti_join, lookup_join, union_by_name
from flowloom.operators.lookups import best_row

DICTIONARY_SCHEMA = "name string, I_ID string"


def pseudonym(name: Column, key: str | None) -> Column:
    """Keyed hash of a name. Without a key of its own a site would publish hashes that anyone can compute."""
    if not key:
        raise ValueError("pseudonyms need a secret key")
    return F.sha2(F.concat(F.lit(key), F.lit(":"), F.lower(name)), 256)


def new_dictionary_entries(names: DataFrame, dictionary: DataFrame, key: str) -> DataFrame:
    """Entries for names the dictionary lacks; ``names`` has one column ``name``."""
    wanted = names.select(F.lower("name").alias("name")).filter(F.col("name").isNotNull()).distinct()
    known = dictionary.select(F.lower("name").alias("name")).distinct()
    return anti_join(wanted, known, ["name"]).withColumn("I_ID", pseudonym(F.col("name"), key))


def pseudonymize(df: DataFrame, columns: dict[str, str], dictionary: DataFrame, key: str) -> DataFrame:
    """Replace each name column by its identifier: the dictionary's where it has one, else the keyed hash."""
    known = dictionary.groupBy(F.lower("name").alias("_name")).agg(F.min("I_ID").alias("_id"))
    result = df
    for name, identifier in columns.items():
        rows = result.withColumn("_name", F.lower(name))
        joined = lookup_join(rows, known, "_name")
        result = joined.withColumn(identifier, F.coalesce("_id", pseudonym(F.col("_name"), key))).drop("_name", "_id", name)
    return result


def active_logins(identities: DataFrame, with_domain: bool = True) -> DataFrame:
    """Active identities that have a login (and a domain)."""
    keep = (F.coalesce(F.col("ADLogin"), F.lit("")) != "") & (F.col("Status") == "ACTIVE")
    if with_domain:
        keep = keep & (F.coalesce(F.col("ADDomain"), F.lit("")) != "")
    return identities.filter(keep)


def first_match(files: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of ordered files, one per key: the earliest file wins, then the greatest row."""
    ranked = union_by_name([f.withColumn("_order", F.lit(-i)) for i, f in enumerate(files)])
    return best_row(ranked, keys, ["_order"]).drop("_order")


def enrich_login(df: DataFrame, user: str, identity_files: list[DataFrame]) -> DataFrame:
    """Users without a domain take the login of the first identity file that knows them."""
    logins = first_match([
        active_logins(f).select(F.lower("ADLogin").alias("_user"), login_of(F.col("ADLogin"), F.col("ADDomain")).alias("_login"))
        for f in identity_files], ["_user"])
    plain = ~F.col(user).contains("@")
    rows = df.withColumn("_user", F.when(plain, F.col(user)))
    return lookup_join(rows, logins, "_user").withColumn(
        user, F.coalesce(F.col("_login"), F.col(user))).select(*df.columns)


IDENTITY_COLUMNS = ["I_ID", "Sector", "SiteCode", "SiteName", "CountryCode", "TerangaCode"]


def resolve_identity(dictionary: DataFrame, identity_files: list[DataFrame], known: DataFrame | None = None) -> DataFrame:
    """Attributes of every identifier: those known before stay, the rest come from the first file with the login."""
    attributes = [c for c in IDENTITY_COLUMNS if c != "I_ID"]
    offers = first_match([
        active_logins(f, with_domain=False).select(
            login_of(F.col("ADLogin"), F.col("ADDomain")).alias("name"),
            sector_path(F.col("Sector"), F.col("SubSector")).alias("Sector"),
            "SiteCode", "SiteName", "CountryCode", "TerangaCode") for f in identity_files], ["name"])
    names = dictionary.select("I_ID", "name").distinct()
    kept = None
    if known is not None:
        kept = best_row(known.select(*IDENTITY_COLUMNS), ["I_ID"], attributes).join(names.select("I_ID").distinct(), "I_ID", "left_semi")
        names = names.join(kept.select("I_ID"), "I_ID", "left_anti")
    found = best_row(names.join(offers, "name").select(*IDENTITY_COLUMNS), ["I_ID"], attributes)
    return found if kept is None else kept.select(*IDENTITY_COLUMNS).unionByName(found)


def pseudonymize_inventory(inventory: DataFrame, device: str, dictionary: DataFrame, key: str) -> DataFrame:
    """Identifier of each device; an unknown one gets a label with its hash, never with its name."""
    known = dictionary.groupBy(F.lower("name").alias("_name")).agg(F.min("I_ID").alias("_id"))
    rows = inventory.withColumn("_name", F.lower(device))
    unknown = F.concat(F.lit("unknown device -"), pseudonym(F.col("_name"), key))
    return lookup_join(rows, known, "_name").withColumn("I_ID_D", F.coalesce("_id", unknown)).drop("_name", "_id", device)


def clean_user(df: DataFrame, column: str, domain_suffix: str) -> DataFrame:
    return df.withColumn(column, normalize_user(F.col(column), domain_suffix))
