"""Operations for preparing training text: dedup, tokens, filters, scoring.

Nothing outside this folder imports it, so it can be removed as a whole.
"""
