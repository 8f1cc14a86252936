"""Sources and sinks: spreadsheet sheets, the newest file of a folder, published results."""
