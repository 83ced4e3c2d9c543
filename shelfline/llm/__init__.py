"""Operators for preparing training corpora, apart from the marketplace engine: nothing else imports them."""
