"""Reading feeds: adapters, parsers, readers."""
