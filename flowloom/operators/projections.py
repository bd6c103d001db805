"""Raw extracts and repositories to typed tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions import (
    address_chars_only, cidr_end, classify_engine, compact_to_iso, day_of, digits_only, gb_to_mb, ip_to_int, map_tier,
    month_of, safe_int, strip_leading_zeros, strip_trailing_quote,
)
from flowloom.operators.filters import live_ranges

# Extract column → table column, in table order.
CONNECTION = {
    "I_ID_D": "I_ID_D",
    "I_ID_U": "I_ID_U",
    "NX_con_start_time": "con_start",
    "NX_con_end_time": "con_end",
    "NX_con_duration": "con_duration",
    "NX_con_cardinality": "con_number",
    "NX_con_destination_ip": "dest_ip",
    "NX_con_out_traffic": "con_traffic_out",
    "NX_con_in_traffic": "con_traffic_in",
    "NX_con_type": "con_protocol",
    "NX_con_status": "con_status",
    "NX_con_port": "dest_port",
    "NX_bin_app_category": "source_app_category",
    "NX_bin_app_company": "source_app_company",
    "NX_bin_app_name": "source_app_name",
    "NX_bin_exec_name": "source_app_exec",
    "NX_bin_paths": "source_app_paths",
    "NX_bin_version": "source_app_version",
    "NX_device_last_ip": "source_ip",
    "engine": "engine",
    "filedt": "filedt",
}
# Columns of the files.
WEBREQUEST = {
    "I_ID_D": "I_ID_D",
    "wr_start_time": "start",
    "wr_end_time": "end",
    "wr_url": "url",
    "wr_destination_port": "dest_port",
    "wr_destination_ip": "dest_ip",
    "wr_application_name": "source_app_name",
    "engine": "engine",
    "filedt": "filedt",
}
# Columns of the files.
EXECUTION = {
    "I_ID_D": "I_ID_D",
    "I_ID_U": "I_ID_U",
    "ex_start_time": "start",
    "ex_end_time": "end",
    "ex_bin_path": "bin_path",
    "ex_cardinality": "cardinality",
    "ex_duration": "duration",
    "ex_status": "status",
    "ex_app_category": "app_category",
    "ex_app_company": "app_company",
    "ex_app_name": "app_name",
    "ex_app_bin_exec_name": "app_bin_exec_name",
    "ex_app_bin_paths": "app_bin_paths",
    "ex_app_bin_version": "app_bin_version",
    "ex_app_bin_hash": "app_bin_hash",
    "ex_device_ip": "source_ip",
    "engine": "engine",
    "filedt": "filedt",
}
END_TIME = {"connection": "con_end", "webrequest": "end", "execution": "end"}
CASTS = {"con_number": "int", "con_traffic_out": "bigint", "con_traffic_in": "bigint", "dest_port": "int"}


def _calendar(df: DataFrame, end: str, server_engines: list[str]) -> DataFrame:
    return df.withColumns({
        "collecttype": classify_engine(F.col("engine"), server_engines),
        "dt": day_of(F.col(end)), "month": month_of(F.col(end))})


def _typed(source: Column, name: str) -> Column:
    if name == "con_duration":
        return safe_int(source).alias(name)
    return (source.try_cast(CASTS[name]) if name in CASTS else source).alias(name)


def project_connection(raw: DataFrame, server_engines: list[str]) -> DataFrame:
    return _calendar(raw.select(*[_typed(F.col(s), n) for s, n in CONNECTION.items()]), "con_end", server_engines)


def project_webrequest(raw: DataFrame, server_engines: list[str]) -> DataFrame:
    return _calendar(raw.select(*[_typed(F.col(s), n) for s, n in WEBREQUEST.items()]), "end", server_engines)


def project_execution(raw: DataFrame, server_engines: list[str]) -> DataFrame:
    """All extract widths in one layout: a missing hash is NULL, a missing device address is empty.

    ``raw`` may be a union by name, where the columns an older file lacks are NULL.
    """
    def column(source: str, name: str) -> Column:
        present = F.col(source) if source in raw.columns else F.lit(None).cast("string")
        return (F.coalesce(present, F.lit("")) if name == "source_ip" else present).alias(name)

    return _calendar(raw.select(*[column(s, n) for s, n in EXECUTION.items()]), "end", server_engines)


EVENT_PROJECTIONS: dict[str, Callable] = {
    "connection": project_connection,
    "webrequest": project_webrequest,
    "execution": project_execution,
}


def project_event(raw: DataFrame, filetype: str, server_engines: list[str]) -> DataFrame:
    """Projection of an event extract; an unknown type passes unchanged."""
    projection = EVENT_PROJECTIONS.get(filetype)
    return projection(raw, server_engines) if projection else raw


def project_snapshot(raw: DataFrame) -> DataFrame:
    """Socket snapshot rows with an ISO time and a clean server address."""
    return raw.withColumns({
        "dt": compact_to_iso(F.col("dt")), "server_ip": strip_trailing_quote(F.col("server_ip"))
    }).withColumn("month", month_of(F.col("dt")))


def name_columns(raw: DataFrame, names: list[str], keep: list[str] | None = None) -> DataFrame:
    """Names for a headerless extract by position, and the columns to keep."""
    if len(raw.columns) != len(names):
        raise ValueError(f"{len(raw.columns)} columns, but {len(names)} names")
    named = raw.toDF(*names)
    return named.select(*keep) if keep else named


def pick_positions(raw: DataFrame, positions: dict[int, str]) -> DataFrame:
    """Columns by position (from 1) under new names."""
    return raw.select(*[F.col(f"`{raw.columns[p - 1]}`").alias(n) for p, n in positions.items()])


# Positional layouts of the raw extracts.
RAW_CONNECTION = [
    "NX_con_start_time", "NX_con_end_time", "NX_con_duration", "NX_con_cardinality", "NX_con_destination_ip",
    "NX_con_out_traffic", "NX_con_in_traffic", "NX_con_type", "NX_con_status", "NX_con_port", "NX_bin_app_category",
    "NX_bin_app_company", "NX_bin_app_name", "NX_bin_exec_name", "NX_bin_paths", "NX_bin_version", "NX_device_name",
    "NX_device_last_ip", "NX_device_last_logged_on_user", "NX_user_name", "NX_user_id", "NX_user_department",
    "NX_user_sid", "NX_user_full_name", "NX_user_distinguished_name",
]
RAW_CONNECTION_KEEP = [*RAW_CONNECTION[:18], "NX_user_name"]
RAW_WEBREQUEST = {
    2: "wr_start_time", 3: "wr_end_time", 11: "wr_url", 17: "wr_device_name", 20: "wr_destination_port",
    21: "wr_destination_ip", 24: "wr_application_name",
}
RAW_EXECUTION_BASE = [
    "ex_start_time", "ex_end_time", "ex_bin_path", "ex_cardinality", "ex_duration", "ex_status", "ex_app_category",
    "ex_app_company", "ex_app_name", "ex_app_bin_exec_name", "ex_app_bin_paths", "ex_app_bin_version",
]
RAW_INVENTORY = [
    "bf_device_name", "LastReportTime", "ComputerCountry", "ComputerLocation", "PrimaryUser", "PrimaryUserId",
    "PrimaryUserEmail", "PrimaryUserCountry", "PrimaryUserLocation", "PrimaryUserSector", "tem_server", "Program",
    "ProductCode", "Version", "UserInstallation", "Count", "ClassName", "SuperClassName",
]
INVENTORY_PERSONAL = ["PrimaryUser", "PrimaryUserId", "PrimaryUserEmail"]


def raw_execution_names(width: int) -> list[str]:
    tails = {
        14: ["ex_user_name", "ex_device_name"],
        15: ["ex_user_name", "ex_device_name", "ex_device_ip"],
        16: ["ex_app_bin_hash", "ex_user_name", "ex_device_name", "ex_device_ip"],
    }
    if width not in tails:
        raise ValueError(f"no execution layout with {width} columns")
    return RAW_EXECUTION_BASE + tails[width]


# Repository projections.

def project_ip_ranges(raw: DataFrame, filedate: str, status: str = "Status", active: str = "Active / Inactive") -> DataFrame:
    """Live address ranges with numeric ends and an id that depends on the content alone."""
    picked = raw.filter(live_ranges(f"`{status}`", f"`{active}`")).select(
        F.col("Location Code").alias("mdm_loc_code"), F.col("Location Name").alias("mdm_loc_name"),
        F.col("Country Code").alias("mdm_loc_country"), address_chars_only(F.col("IP Address")).alias("mdm_ip_start"),
        digits_only(F.col("Mask")).try_cast("int").alias("mdm_ip_range"), F.lit(filedate).alias("filedate"))
    valid = picked.filter(F.col("mdm_ip_range") > 0).withColumn("mdm_ip_start_int", ip_to_int(F.col("mdm_ip_start")))
    identity = F.xxhash64("mdm_loc_code", "mdm_loc_name", "mdm_loc_country", "mdm_ip_start", "mdm_ip_range")
    return valid.withColumns({
        "mdm_ip_end_int": cidr_end(F.col("mdm_ip_start_int"), F.col("mdm_ip_range")), "mdm_id": identity})


LOWER, ID = "lower", "id"  # how a repository column is cleaned: lower case, or no leading zeros

# Columns of the files.
SERVER = {
    "aip_server_hostname": ("Host name", LOWER),
    "aip_server_phys_host": "Physical Server name",
    "aip_server_size": "Size",
    "aip_server_function": "Function",
    "aip_server_type": "Type",
    "aip_server_subfunction": "Sub-Function",
    "aip_server_ip": "IP address",
    "aip_server_vmw_host": "For Hosting Virtual Servers Only",
    "aip_server_status": "Status",
    "aip_server_site": "Site code",
    "aip_server_site_name": "Site Name",
    "aip_server_ownership": "Leased or owned",
    "aip_server_cpu_type": "CPU Name",
    "aip_server_cpu_num": "CPUs number",
    "aip_server_cpu_cores": "Core number",
    "aip_server_owner": "Leased or owned",
    "aip_server_vendor": "Vendor",
    "aip_server_model": "Model",
    "aip_server_role": "Operational role",
    "aip_server_source": "Source",
    "aip_server_os_name": "OS Name",
}
# Columns of the files.
APPLICATION = {
    "aip_app_name": "Application Name",
    "aip_app_shared_unique_id": ("Shared Unique ID", ID),
    "aip_app_type": "Type",
    "aip_app_validation": "Validation",
    "aip_app_state": "Current State",
    "aip_app_sensitive": "Sensitive Application",
    "aip_app_criticality": "Criticality",
    "aip_app_sector": "Sector",
    "aip_app_it_owner": "IT Owner",
    "aip_app_is_owner": "IS Owner",
}
# Columns of the files.
GRID_FUSION = {
    "aip_appgf_name": "Name",
    "aip_appgf_shared_unique_id": ("Shared Unique ID", ID),
    "aip_appgf_type": "Type",
    "aip_appgf_grid_app_name": "GridFusion Application Name",
    "aip_appgf_billing_code": "Billing Code",
}
# Columns of the files.
SOFT_INSTANCE = {
    "aip_appinstance_name": "Application name",
    "aip_appinstance_shared_unique_id": ("Shared Unique ID", ID),
    "aip_appinstance_type": "Type",
    "aip_appinstance_hostname": ("Host name", LOWER),
    "aip_appinstance_ip": "IP address",
    "aip_appinstance_sector": "Application Sector",
    "aip_appinstance_state": "Application current state",
}
# Columns of the files.
ORG_DEPLOY = {
    "aip_orgdeploy_name": "Application Name",
    "aip_orgdeploy_shared_unique_id": ("Shared Unique ID", ID),
    "aip_orgdeploy_unit_uid": "Org unit UID",
    "aip_orgdeploy_unit_name": "Org unit Name",
    "aip_orgdeploy_unit_terranga_code": "Org unit Teranga code",
    "aip_orgdeploy_unit_type": "Org unit Type",
    "aip_orgdeploy_users_nb": "Expected number of users",
}
# Columns of the files.
SOFTWARE = {
    "aip_software_name": "Application",
    "aip_software_shared_unique_id": ("Unique ID", ID),
    "aip_software_gapm_id": "GAPM ID",
    "aip_software_adc_support": "ADC Support",
    "aip_software_app_based_on": "Application Based on",
    "aip_software_main_product": "Main Product ?",
    "aip_software_editor": "Editor",
    "aip_software_product_name": "Product Name",
    "aip_software_product_type": "Product Type",
    "aip_software_product_version": "Product Version",
    "aip_software_product_edition": "Product Edition",
}
# Columns of the files.
IDENTITY = {c: c for c in ("I_ID", "SiteCode", "SiteName", "CountryCode", "Sector", "TerangaCode")}


def project_renamed(raw: DataFrame, columns: dict, filedate: str) -> DataFrame:
    """Repository columns under their table names."""
    def column(source) -> Column:
        header, how = source if isinstance(source, tuple) else (source, None)
        value = F.col(f"`{header}`")
        return F.lower(value) if how == LOWER else strip_leading_zeros(value) if how == ID else value

    return raw.select(*[column(s).alias(n) for n, s in columns.items()], F.lit(filedate).alias("filedate"))


def first_header(raw: DataFrame, suffix: str) -> str:
    """The header that equals ``suffix`` or ends with it after other words; the longest spelling wins."""
    found = [c for c in raw.columns if c == suffix or c.endswith(" " + suffix)]
    if not found:
        raise ValueError(f"no column named {suffix}")
    return max(found, key=len)


def project_applications(raw: DataFrame, filedate: str) -> DataFrame:
    """Applications; the criticality header has had several spellings, all ending in the same word."""
    return project_renamed(raw, {**APPLICATION, "aip_app_criticality": first_header(raw, "Criticality")}, filedate)


def project_storage(raw: DataFrame, filedate: str) -> DataFrame:
    """Billable storage per server and mount, in megabytes."""
    return raw.filter(F.col("ServerBillableForStorage") == "Yes").select(
        F.lower("sServerName").alias("server"), F.lower("sPartition").alias("mount"),
        map_tier(F.col("StorageTier")).alias("type"), gb_to_mb(F.col("UsedMeassureGb")).alias("charged_used_mb"),
        gb_to_mb(F.col("TotalMeassureGb")).alias("charged_total_mb"), F.lit(filedate).alias("filedate"))


REPOSITORY_PROJECTIONS: dict[str, Callable[[DataFrame, str], DataFrame]] = {
    "MDM-ITC": project_ip_ranges,
    "AIP-Server": lambda raw, day: project_renamed(raw, SERVER, day),
    "AIP-Application": project_applications,
    "AIP-AppGFtoApp": lambda raw, day: project_renamed(raw, GRID_FUSION, day),
    "AIP-SoftInstance": lambda raw, day: project_renamed(raw, SOFT_INSTANCE, day),
    "AIP-OrgDeploy": lambda raw, day: project_renamed(raw, ORG_DEPLOY, day),
    "AIP-Software": lambda raw, day: project_renamed(raw, SOFTWARE, day),
    "I-ID": lambda raw, day: project_renamed(raw, IDENTITY, day),
    "Storage-Master-Report": project_storage,
}
# Older names of the repositories.
REPOSITORY_ALIASES = {
    "CartoServer": "AIP-Server",
    "CartoSoftInstance": "AIP-SoftInstance",
    "CartoApplication": "AIP-Application",
    "CartoAppGFtoApp": "AIP-AppGFtoApp",
    "CartoAppSoftware": "AIP-Software",
    "CartoOrgDeploy": "AIP-OrgDeploy",
}


def repository_of(file_name: str) -> tuple[str, str]:
    """Repository and snapshot day of a file named ``<type>_<YYYYMMDD>.<ext>``."""
    match = re.fullmatch(r"([^_]+)_(\d{4})(\d\d)(\d\d)\..*", file_name.rsplit("/", 1)[-1])
    if not match:
        raise ValueError(f"{file_name} does not carry a type and a date")
    name = REPOSITORY_ALIASES.get(match[1], match[1])
    if name not in REPOSITORY_PROJECTIONS:
        raise ValueError(f"unknown repository {name}")
    return name, f"{match[2]}-{match[3]}-{match[4]}"


def project_repository(raw: DataFrame, name: str, filedate: str) -> DataFrame:
    if name not in REPOSITORY_PROJECTIONS:
        raise ValueError(f"unknown repository {name}")
    return REPOSITORY_PROJECTIONS[name](raw, filedate)
