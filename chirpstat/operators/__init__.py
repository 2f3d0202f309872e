"""DataFrame operators: validity, analyses, selections."""
