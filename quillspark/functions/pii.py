"""Pattern flags and masks of personal data, as columns; null texts have no flag and stay null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, what is known not to be a datum, and masks.
PATTERNS = {
    "email": r"(?i)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "phone": r"(?:\+?1[-.\s]?)?\(?[0-9]{3}\)?[-.\s]?[0-9]{3}[-.\s]?[0-9]{4}",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b|\b[0-9]{9}\b",
    "credit_card": r"\b(?:[0-9]{4}[-\s]?){3}[0-9]{4}\b",
    "ip_address": r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b",
    "id_number": r"(?i)\b[A-Z]{1,2}[0-9]{6,10}\b",
}
NO_DATA = {
    "ip_address": ["127.0.0.1", "0.0.0.0", "192.168.", "10.0.", "172.16."],
    "phone": ["123-456-7890", "000-000-0000", "111-111-1111"],
    "credit_card": ["0000-0000-0000-0000", "1234-5678-9012-3456"],
}
MASKS = {"email": "[EMAIL_REDACTED]", "phone": "[PHONE_REDACTED]", "ssn": "[SSN_REDACTED]", "credit_card": "[CC_REDACTED]"}
NO_NAMES = ["The Internet", "New York", "United States", "Web Services", "Machine Learning", "Artificial Intelligence", "User Guide"]
FLAGS = ["email", "phone", "ssn", "credit_card", "ip_address", "person_name", "address", "id_number"]
# What names and streets look like.
_NAME = r"\b[A-Z][a-z]+ [A-Z][a-z]+(?:\s[A-Z][a-z]+)?\b"
STREET = r"(?i)\b[0-9]{1,5}\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*\s+(?:Street|St|Avenue|Ave|Road|Rd|Boulevard|Blvd|Lane|Ln|Drive|Dr|Court|Ct|Circle|Cir|Place|Pl)\b"


def _false(match: Column, kind: str) -> Column:
    hit = F.lit(False)
    for part in NO_DATA.get(kind, []):
        hit = hit | match.contains(part)
    return hit


def pii_flags(text: Column, kinds: list[str] | None = None) -> Column:
    """Struct of booleans, one for each of ``kinds`` (all eight by default)."""
    t = F.coalesce(text, F.lit(""))

    def flag(kind: str) -> Column:
        if kind == "person_name":
            return F.size(F.filter(F.regexp_extract_all(t, F.lit(_NAME), F.lit(0)), lambda m: ~m.isin(NO_NAMES))) > 2
        if kind == "address":
            return F.regexp_like(t, F.lit(STREET))
        if kind in NO_DATA:
            return F.exists(F.regexp_extract_all(t, F.lit(PATTERNS[kind]), F.lit(0)), lambda m: ~_false(m, kind))
        return F.regexp_like(t, F.lit(PATTERNS[kind]))

    return F.struct(*[flag(k).alias(k) for k in kinds or FLAGS])


def redact_pii(text: Column, flags: Column | None = None) -> Column:
    """Masks, in this order: mail addresses, telephone, social security and card numbers, IP addresses.

    With ``flags`` only kinds that are set are masked. Addresses of local networks stay.
    """
    out = text
    for kind, mask in MASKS.items():
        masked = F.regexp_replace(out, PATTERNS[kind], mask)
        out = masked if flags is None else F.when(flags[kind], masked).otherwise(out)
    ip = r"\b(?!127\.0\.0\.1\b|0\.0\.0\.0\b|192\.168\.|10\.0\.|172\.16\.)(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b"
    masked = F.regexp_replace(out, ip, "[IP_REDACTED]")
    return masked if flags is None else F.when(flags["ip_address"], masked).otherwise(out)


def pii_summary(flags: Column, kinds: list[str] | None = None) -> Column:
    """Names of the flags that are set, or a sentence if none is."""
    found = F.array_compact(F.array(*[F.when(flags[k], F.lit(k)) for k in kinds or FLAGS]))
    return F.when(F.size(found) > 0, F.array_join(found, ", ")).otherwise("No PII detected")
