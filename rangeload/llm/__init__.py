"""Operators for preparing large text and vector corpora; nothing else imports this."""
