"""Raw file readers (text layouts), file discovery and sinks."""
