"""DataFrame operators: extraction, classification, offers, joins, numbering."""
