"""DataFrame-to-DataFrame operators over one or two domain frames."""
