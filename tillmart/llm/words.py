"""Words of the contracts, as byte tables: every byte beyond ASCII belongs to a word."""

#: A-Z as a-z; letters, digits and bytes beyond ASCII as they are; all else a blank
LETTERS_AND_DIGITS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
