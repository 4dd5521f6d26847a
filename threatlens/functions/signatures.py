"""Attack signatures: regular expressions, category order, scores."""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The signature patterns. The historical set is wider than the live
# set (DELETE FROM, onload=, /proc/self).
TOOL_PATTERN = (
    r"(?i)(sqlmap|nikto|nmap|masscan|burpsuite|dirbuster|hydra|metasploit|w3af|acunetix|openvas)"
)
HISTORY_SQLI_PATTERN = (
    r"(?i)('\s+OR|UNION\s+SELECT|1=1--|DROP\s+TABLE|xp_cmdshell|EXEC\(|INSERT\s+INTO|DELETE\s+FROM)"
)
HISTORY_XSS_PATTERN = (
    r"(?i)(<script|javascript:|onerror=|alert\(|document\.cookie|eval\(|onload=)"
)
HISTORY_LFI_PATTERN = r"(?i)(\.\./\.\./|/etc/passwd|/etc/shadow|/proc/self|%2e%2e%2f)"
LIVE_SQLI_PATTERN = (
    r"(?i)('\s+OR|UNION\s+SELECT|1=1--|DROP\s+TABLE|xp_cmdshell|EXEC\(|INSERT\s+INTO)"
)
LIVE_XSS_PATTERN = r"(?i)(<script|javascript:|onerror=|alert\(|document\.cookie|eval\()"
LIVE_LFI_PATTERN = r"(?i)(\.\./\.\./|/etc/passwd|/etc/shadow|%2e%2e%2f)"


# What the first two characters of any match can be. Checked before the alternatives
# are tried at a position, they leave the answer alone and more than halve its cost.
TOOL_OPENING = r"[snmbdhwao][qimauyec3p]"
SQLI_OPENING = r"['u1dxei][\sn=rpxe]"
XSS_OPENING = r"[<joade][sanlov]"
LFI_OPENING = r"[./%][.ep2]"


def guarded(pattern: str, opening: str) -> str:
    return f"(?i)(?={opening})" + pattern.removeprefix("(?i)")


@dataclass(frozen=True)
class Signature:
    flag: str
    column: str
    pattern: str
    opening: str
    name: str
    score: int

    def matches(self) -> Column:
        # NULL text gives NULL, not FALSE: an unknown field proves nothing.
        return F.col(self.column).rlike(guarded(self.pattern, self.opening))


@dataclass(frozen=True)
class SignatureSet:
    """Signatures from highest to lowest priority, and the fallback category."""

    signatures: tuple[Signature, ...]
    fallback_name: str
    fallback_score: int

    def any_match(self) -> Column:
        condition = self.signatures[0].matches()
        for s in self.signatures[1:]:
            condition = condition | s.matches()
        return condition

    def flags(self) -> list[Column]:
        return [s.matches().alias(s.flag) for s in self.signatures]

    def category(self) -> Column:
        return self._first_match("name", self.fallback_name)

    def score(self) -> Column:
        return self._first_match("score", self.fallback_score)

    def _first_match(self, field: str, fallback) -> Column:
        return F.coalesce(
            *[F.when(F.col(s.flag), F.lit(getattr(s, field))) for s in self.signatures],
            F.lit(fallback),
        )


# Category names and scores of the historical and the live set.
HISTORY = SignatureSet(
    (
        Signature("is_tool", "user_agent", TOOL_PATTERN, TOOL_OPENING, "TOOL_DETECTED", 95),
        Signature("is_sqli", "request_path", HISTORY_SQLI_PATTERN, SQLI_OPENING, "SQLI", 85),
        Signature("is_xss", "request_path", HISTORY_XSS_PATTERN, XSS_OPENING, "XSS", 75),
        Signature("is_lfi", "request_path", HISTORY_LFI_PATTERN, LFI_OPENING, "LFI", 70),
    ),
    "UNKNOWN",
    60,
)
LIVE = SignatureSet(
    (
        Signature("is_tool", "user_agent", TOOL_PATTERN, TOOL_OPENING, "KNOWN_ATTACK_TOOL", 95),
        Signature("is_sqli", "request_path", LIVE_SQLI_PATTERN, SQLI_OPENING, "SQLI_DETECTED", 85),
        Signature("is_xss", "request_path", LIVE_XSS_PATTERN, XSS_OPENING, "XSS_DETECTED", 75),
        Signature("is_lfi", "request_path", LIVE_LFI_PATTERN, LFI_OPENING, "LFI_DETECTED", 70),
    ),
    "SIGNATURE_MATCH",
    60,
)
