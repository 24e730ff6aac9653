"""DataFrame operators over signals, labels, beats, windows and scores."""
