"""Network address expressions."""

from __future__ import annotations

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9]{2}|0*[0-9]{1,2})"
_IPV4 = f"^{_OCTET}([.]{_OCTET}){{3}}$"


def ipv4_number(address: str) -> str:
    """Dotted-quad address as a number, NULL for anything else."""
    octets = " + ".join(
        f"try_cast(split_part({address}, '.', {i}) AS BIGINT) * {256 ** (4 - i)}"
        for i in (1, 2, 3, 4)
    )
    return f"CASE WHEN {address} RLIKE r'{_IPV4}' THEN {octets} END"
