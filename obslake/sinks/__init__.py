"""Writers for topics, file trees and tables."""
