"""IPv4, port and socket expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "ip_to_int", "int_to_ip", "cidr_end", "open_sequence", "is_internal_ip", "default_site",
    "classify_engine", "map_tcp_state", "socket_endpoints", "listen_port", "decode_port", "MAX_IPV4",
]

MAX_IPV4 = 4294967295
INTERNAL_LOW, INTERNAL_HIGH = 10 << 24, (11 << 24) - 1  # 10.0.0.0/8

# Socket states that count as a finished connection, and the two that do not.
CLOSED_STATES = ["(ESTABLISHED)", "(CLOSE-WAIT)", "(FIN-WAIT-1)", "(FIN-WAIT-2)", "(CLOSING)", "(TIME-WAIT)"]
OPEN_STATES = {"(SYN-SENT)": "SYN-SENT", "(SYN-RECEIVED)": "RECEIVED"}

# Meaning of the digits of a five-digit service port.
PORT_ZONES = {"1": "front", "2": "back"}
PORT_ENVIRONMENTS = {"0": "ECC", "1": "UM", "2": "ECF", "4": "ECM"}
PORT_PROTOCOLS = {"00": "HTTP", "01": "HTTPS"}


def _literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def ip_to_int(ip: Column) -> Column:
    """Dotted quad to an unsigned number; NULL unless it has four parts of 0..255."""
    octets = [F.split_part(ip, F.lit("."), F.lit(i)).try_cast("bigint") for i in (1, 2, 3, 4)]
    number = octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3]
    valid = ip.rlike(r"^[0-9]{1,3}([.][0-9]{1,3}){3}$") & (F.greatest(*octets) <= 255)
    return F.when(valid, number)


def int_to_ip(number: Column) -> Column:
    value = number.cast("bigint")
    parts = [F.shiftright(value, shift).bitwiseAND(F.lit(255)).cast("string") for shift in (24, 16, 8)]
    parts.append(value.bitwiseAND(F.lit(255)).cast("string"))
    return F.when(value.between(0, MAX_IPV4), F.concat_ws(".", *parts))


def cidr_end(start: Column, prefix: Column) -> Column:
    """Last address of the block of ``prefix`` bits that begins at ``start``."""
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.lit(32) - prefix).cast("int"))
    return start + size - 1


def open_sequence(start: Column, stop: Column) -> Column:
    """Whole numbers strictly between the two bounds; empty when there are none."""
    empty = F.array().cast("array<bigint>")
    return F.when(stop - start >= 2, F.sequence(start + 1, stop - 1)).otherwise(empty)


def is_internal_ip(ip: Column, strict: bool = True) -> Column:
    """Inside 10.0.0.0/8. ``strict=False`` keeps the loose text test, which also accepts ``10.1.2`` and ``110.1.2.3``."""
    if strict:
        return F.coalesce(ip_to_int(ip).between(INTERNAL_LOW, INTERNAL_HIGH), F.lit(False))
    return F.coalesce(ip.rlike(r"10\.([0-9]+\.)+[0-9]+"), F.lit(False))


def default_site(site: Column) -> Column:
    return F.coalesce(F.nullif(site, F.lit("")), F.lit("nf"))


def classify_engine(engine: Column, server_engines: list[str]) -> Column:
    return F.when(engine.isin(list(server_engines)), "server").otherwise("device")


def map_tcp_state(state: Column) -> Column:
    result = F.when(state.isin(CLOSED_STATES), "closed")
    for raw, name in OPEN_STATES.items():
        result = result.when(state == raw, name)
    return result


def socket_endpoints(name: Column) -> dict[str, Column]:
    """The four parts of ``local_ip:port->remote_ip:port``; NULL when the text has another shape."""
    pattern = r"^(.*):(.*)->(.*):(.*)$"
    names = ("con_local_ip", "con_local_port", "con_foreign_ip", "con_foreign_port")
    return {n: F.when(name.rlike(pattern), F.regexp_extract(name, pattern, i + 1)) for i, n in enumerate(names)}


def listen_port(name: Column) -> Column:
    return F.regexp_extract(name, r"^(.*):(.*)$", 2)


def decode_port(port: Column) -> dict[str, Column]:
    """Zone, environment, protocol and version carried by the digits of a port number."""
    digits = port.cast("string")
    zone = F.coalesce(F.try_element_at(_literal_map(PORT_ZONES), F.substring(digits, 1, 1)), F.lit("front"))
    env = F.coalesce(F.try_element_at(_literal_map(PORT_ENVIRONMENTS), F.substring(digits, 2, 1)), F.lit(""))
    protocol = F.coalesce(F.try_element_at(_literal_map(PORT_PROTOCOLS), F.substring(digits, 3, 2)), F.lit("HTTP"))
    fifth = F.substring(digits, 5, 1)
    version = F.when(fifth.try_cast("int") > 0, F.concat(F.lit("n+"), fifth)).otherwise("n")
    return {"zone": zone, "env": env, "protocol": protocol, "version": version}
