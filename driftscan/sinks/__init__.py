"""Writers of chunked and multi-scale array stores."""
