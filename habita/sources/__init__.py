"""Sources: wire messages (stream/files), API documents, HTML pages, adapters
that derive listing-shaped inputs from the driver tables."""
