"""Raw tables in, built tables out."""
