"""Operators for large corpora of training text; nothing else imports them."""
