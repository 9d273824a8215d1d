"""siltstone: Spark-native operators for scraped, semi-structured text and its audits."""
