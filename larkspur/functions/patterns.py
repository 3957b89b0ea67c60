"""Detection patterns and word lists.

Fixed values: patterns, labels and messages must stay as they are for results to match.
"""

EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE = r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b"
SSN = r"\b\d{3}-\d{2}-\d{4}\b"
CARD = r"\b(?:\d[ -]*?){13,19}\b"
IPV4 = r"\b(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})\b"

# (pattern, provider)
API_KEYS = (
    (r"\bsk-[A-Za-z0-9]{20,}\b", "OpenAI"),
    (r"\bAKIA[A-Z0-9]{16}\b", "AWS"),
    (r"\bghp_[A-Za-z0-9]{36,}\b", "GitHub"),
    (r"\bgho_[A-Za-z0-9]{36,}\b", "GitHub OAuth"),
    (r"\bglpat-[A-Za-z0-9\-]{20,}\b", "GitLab"),
    (r"\bxoxb-[A-Za-z0-9\-]{20,}\b", "Slack Bot"),
    (r"\bxoxp-[A-Za-z0-9\-]{20,}\b", "Slack User"),
)

# (pattern, replacement, type)
PII = (
    (EMAIL, "<EMAIL>", "email"),
    (PHONE, "<PHONE>", "phone"),
    (SSN, "<SSN>", "ssn"),
    (r"\bsk-[A-Za-z0-9]{20,}\b", "<API_KEY>", "api_key"),
    (r"\bAKIA[A-Z0-9]{16}\b", "<API_KEY>", "api_key"),
    (r"\bghp_[A-Za-z0-9]{36,}\b", "<API_KEY>", "api_key"),
)

LEAK_PHRASES = (
    "Ignore previous instructions",
    "You are a helpful assistant",
    "system prompt",
    "You are an AI",
    "As an AI language model",
)

# Matched without regard to case; ``^`` matches at every line start.
INJECTION = (
    r"ignore\s+(all\s+)?previous\s+instructions",
    r"ignore\s+(all\s+)?above\s+instructions",
    r"you\s+are\s+now\s+",
    r"^system\s*:",
    r"<\|?\s*system\s*\|?>",
    r"\brole\s*:\s*system\b",
    r"```\s*system\b",
    r"act\s+as\s+(if\s+you\s+are\s+)?a?\s*(new|different)\s+ai",
    r"disregard\s+(all\s+)?(prior|previous)",
    r"override\s+(your\s+)?(instructions|rules|guidelines)",
)

# (pattern, category, detail)
SAFETY = (
    (r"sk-[a-zA-Z0-9]{20,}", "pii_leakage", "API key detected in output"),
    (r"(?i)system\s*prompt\s*:", "prompt_injection", "System prompt leak attempt"),
    (r"\b\d{3}-\d{2}-\d{4}\b", "pii_leakage", "SSN pattern in output"),
    (r"(?i)(ignore|disregard)\s+(previous|above)\s+(instructions?|prompt)", "prompt_injection", "Injection echo"),
)

DENY_TERMS = ("ignore previous instructions", "system prompt", "delete all")

# Matched on lower-cased text.
PROMPT_GUARD = (
    r"ignore\s+(previous|all|above)",
    r"disregard\s+(previous|all|instructions)",
    r"system\s*:",
    r"<\|im_start\|>",
    r"<\|im_end\|>",
    r"###\s*instruction",
)

SECRET_NAMES = ("password", "secret", "api_key")
