"""Steps for module variables, resolved imports and app configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codequarry.graph.model import KEY
from codequarry.graph.steps import Cpg, Steps

# Module variables: locals of methods that stand for a module.


def module_variables(cpg: Cpg) -> Steps:
    return Steps.of(cpg.method().is_module().locals())


def references(variables: Steps) -> Steps:
    """Identifiers that refer to a module variable."""
    return Steps.of(variables.in_("REF", label="IDENTIFIER"))


def definitions(variables: Steps) -> Steps:
    """Assignments whose target is a reference."""
    t = references(variables).where("argument_index = 1").in_call()
    return Steps.of(t.where(F.col("name").startswith("<operator>.assignment")))


def invoking_calls(variables: Steps) -> Steps:
    """Calls on a reference."""
    return references(variables).where("argument_index = 0").in_call()


def referencing_members(variables: Steps) -> Steps:
    """Members with the variable's name, of the declaration with its module's full name."""
    v = variables.keeping("_v").withcol("_name", F.col("name")).nearest("METHOD").withcol("_module", F.col("full_name"))
    decl = v.graph.nodes.where("label = 'TYPE_DECL'").select(F.col("graph_id").alias("_g"), F.col("id").alias("_far"), F.col("full_name").alias("_full"))
    ends = v.df.join(decl, (F.col("graph_id") == F.col("_g")) & (F.col("_module") == F.col("_full"))).select("_g", "_far", F.col("_name").alias("_member"))
    t = Steps(v.graph, v.df, ("_member",))._at(ends, "TYPE_DECL").out("AST", label="MEMBER").where("name = _member")
    return Steps(v.graph, t.df.drop("_member"))


# Imports: tags of a call hold what it resolves to, as base64 of 'kind:full name'.


def resolved_entities(calls: Steps, tag: str = "resolved_import") -> Steps:
    """Methods, types and members that tagged calls resolve to."""
    t = calls.out("TAGGED_BY", label="TAG").exact("name", tag)
    ends = t.df.select("graph_id", F.decode(F.unbase64("value"), "UTF-8").alias("_text"))
    ends = ends.select(F.col("graph_id").alias("_g"), F.regexp_extract("_text", r"^(\w+):(.*)$", 1).alias("_kind"), F.regexp_extract("_text", r"^(\w+):(.*)$", 2).alias("_full"))
    n = calls.graph.nodes
    label = F.when(F.col("_kind") == "method", "METHOD").when(F.col("_kind") == "type", "TYPE_DECL").when(F.col("_kind") == "member", "MEMBER")
    hit = n.join(ends, (F.col("graph_id") == F.col("_g")) & (F.coalesce("full_name", "name") == F.col("_full")) & (F.col("label") == label)).drop("_g", "_kind", "_full")
    return Steps(calls.graph, hit)


# App configuration.


def app_manifest(cpg: Cpg) -> Steps:
    return cpg.config_file().where(F.col("name").endswith("AndroidManifest.xml"))


def _plain(content: Column) -> Column:
    """XML without namespace prefixes, so that attributes are found by their names."""
    return F.regexp_replace(content, r"\bandroid:", "")


def uses_cleartext_traffic(manifests: Steps) -> Steps:
    return manifests.where(F.xpath_string(_plain(F.col("content")), F.lit("string(//application/@usesCleartextTraffic)")) == "true")


def reads_external_storage(manifests: Steps) -> Steps:
    return manifests.where(F.array_contains(F.xpath(_plain(F.col("content")), F.lit("//uses-permission/@name")), "android.permission.READ_EXTERNAL_STORAGE"))


def reaches_default_category(manifests: Steps) -> DataFrame:
    """(graph_id, name) of the activities that implicit intents reach: those with an intent filter of the default category."""
    path = "/manifest/application/activity[intent-filter/category/@name='android.intent.category.DEFAULT']/@name"
    return manifests.df.select("graph_id", F.explode(F.xpath(_plain(F.col("content")), F.lit(path))).alias("name")).distinct()


def exported_receivers(manifests: Steps) -> DataFrame:
    """(graph_id, name) of the broadcast receivers that are exported and have an intent filter, without a leading dot."""
    path = "/manifest/application/receiver[intent-filter and @exported='true']/@name"
    names = manifests.df.select("graph_id", F.explode(F.xpath(_plain(F.col("content")), F.lit(path))).alias("name"))
    return names.select("graph_id", F.regexp_replace("name", r"^\.", "").alias("name")).distinct()


def names_cleartext_traffic(manifests: Steps) -> Steps:
    """Manifests whose application has the attribute at all, whatever its value: what scanners ask for."""
    return manifests.where(F.size(F.xpath(_plain(F.col("content")), F.lit("/manifest/application/@usesCleartextTraffic"))) > 0)


def web_views(cpg: Cpg) -> Steps:
    return cpg.local().where("type_full_name = 'android.webkit.WebView'")


def calls_on(variables: Steps, name: str) -> Steps:
    """Calls of a name that a variable is an argument of, such as loadUrl of a web view."""
    return Steps.of(variables.in_("REF", label="IDENTIFIER")).in_call().exact("name", name)


def _typed(index: int, kind: str):
    return lambda t: t.out("AST", label="METHOD_PARAMETER_IN").where((F.col("index") == index) & (F.col("type_full_name") == kind))


def _identifier(index: int, kind: str):
    return lambda t: t.argument(index).label("IDENTIFIER").where(F.col("type_full_name") == kind)


def broadcast_receivers(cpg: Cpg) -> Steps:
    """Types with a method onReceive(context, intent)."""
    m = cpg.method().exact("name", "onReceive").where_step(_typed(1, "android.content.Context")).where_step(_typed(2, "android.content.Intent"))
    return m.defining_type_decl()


def register_receiver(cpg: Cpg) -> Steps:
    return cpg.call().exact("name", "registerReceiver").where_step(_identifier(2, "android.content.IntentFilter"))


def registered_broadcast_receivers(cpg: Cpg) -> Steps:
    """Receivers of whose type some first argument of registerReceiver is."""
    known = register_receiver(cpg).argument(1).label("IDENTIFIER").df.select("graph_id", F.col("type_full_name").alias("full_name")).distinct()
    t = broadcast_receivers(cpg)
    return t._with(t.df.join(known, ["graph_id", "full_name"], "left_semi"))


def external_storage_dir(cpg: Cpg) -> Steps:
    return cpg.call().exact("name", "getExternalStorageDirectory").where_step(_identifier(0, "android.os.Environment"))


def dex_class_loaders(cpg: Cpg) -> Steps:
    return cpg.local().where("type_full_name = 'dalvik.system.DexClassLoader'")


def enabling_script(variables: Steps) -> Steps:
    """Web views on whose settings setJavaScriptEnabled(true) is called."""
    on = lambda t: t.in_call().exact("name", "setJavaScriptEnabled").argument().label("LITERAL").exact("code", "true")
    return variables.where_step(lambda t: Steps.of(t.in_("REF", label="IDENTIFIER")).in_call().exact("name", "getSettings").where_step(on))


def load_url_calls(variables: Steps) -> Steps:
    return calls_on(variables, "loadUrl")


def add_script_interface_calls(variables: Steps) -> Steps:
    return calls_on(variables, "addJavascriptInterface")


def exposed_to_script(cpg: Cpg) -> Steps:
    return cpg.method().where_step(lambda t: t.out("AST", label="ANNOTATION").where("full_name = 'android.webkit.JavascriptInterface'"))
