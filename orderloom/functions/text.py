"""Text expressions: code splitting, store names, quote doubling."""

from __future__ import annotations

from orderloom.functions import quoted, rules


def quote_escape(text: str) -> str:
    """Double every single quote."""
    return f"""replace({text}, "'", "''")"""


def before_first(text: str, mark: str) -> str:
    """Trimmed text before the first mark; all of it if there is none."""
    return f"trim(substring_index({text}, {quoted(mark)}, 1))"


def after_last(text: str, mark: str) -> str:
    """Trimmed text after the last mark; all of it if there is none."""
    return f"trim(substring_index({text}, {quoted(mark)}, -1))"


def excluded_channel(channel_code: str) -> str:
    return f"lower({channel_code}) rlike {quoted('|'.join(rules.EXCLUDED_CHANNEL_WORDS))}"


def official_store(channel_code: str, channel_name: str, case_insensitive: bool = False) -> str:
    """Store part of `<marketplace>-<store>`; B2B names without a dash use the code's suffix."""
    pattern = ("(?i)" if case_insensitive else "") + "|".join(rules.B2B_NAMES)
    return f"""case when {channel_name} rlike {quoted(pattern)} and not contains({channel_name}, '-')
        then {after_last(channel_code, '_')} else {after_last(channel_name, '-')} end"""


def clean_store_name(store: str) -> str:
    """Apply the renames, else strip the characters a store name may not have."""
    renamed = " ".join(
        f"when startswith(lower({store}), {quoted(prefix)}) then {quoted(name)}"
        for prefix, name in rules.STORE_RENAMES.items()
    )
    return f"case {renamed} else trim(regexp_replace({store}, {quoted(rules.STORE_NAME_JUNK)}, '')) end"
