"""Named queries over the sample tables, each with an independent SQL oracle."""
