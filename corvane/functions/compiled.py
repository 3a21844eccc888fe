"""MinHash signatures as a function of the JVM, where a hash costs less than the call of Spark's `sha2` or Python's hashlib.

The function is written in Java, compiled on the driver when it is first asked for, and sent to executors as a jar. Spark's
compiler of generated code makes all of it but Lanes, which needs Java's own; where there is none, digests serve.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
from py4j.java_gateway import JavaClass
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from corvane.functions.vectors import _ROUND, _START

NAME = "corvane_text_signature"

_CLASS = "corvane.TextSignature"
_SOURCE = """
package corvane;

import java.security.MessageDigest;
import java.util.Arrays;

interface Hashes {
    /** out[1 + i]: the least of the first 32 bits of sha256('<i>:<key>') over the keys, as 8 hex digits each, for i below n. */
    void least(long[] keys, int n, long[] out) throws Exception;
}

/** The number of distinct k-grams of words that byte 31 joins, then the least hash of each permutation. */
public final class TextSignature implements org.apache.spark.sql.api.java.UDF3 {
    private static final Hashes HASHES = hashes();

    /** Vectors where this JVM has them. */
    private static Hashes hashes() {
        try {
            return (Hashes) Class.forName("corvane.Lanes").getDeclaredConstructor(new Class[0]).newInstance(new Object[0]);
        } catch (ReflectiveOperationException e) {
            return new Digests();
        } catch (LinkageError e) {
            return new Digests();
        }
    }

    static long first(byte[] hash) {
        return (hash[0] & 255L) << 24 | (hash[1] & 255) << 16 | (hash[2] & 255) << 8 | hash[3] & 255;
    }

    /** The first 32 bits of the sha256 of each gram, in order, each once. */
    private static long[] keys(byte[] words, int k, MessageDigest sha256) {
        if (words.length == 0) return new long[0];
        int n = 1;
        for (int at = 0; at < words.length; at++) if (words[at] == 31) n++;
        int[] starts = new int[n + 1];
        int word = 1;
        for (int at = 0; at < words.length; at++) if (words[at] == 31) starts[word++] = at + 1;
        starts[n] = words.length + 1;
        long[] found = new long[Math.max(n - k + 1, 1)];
        for (int i = 0; i < found.length; i++) {
            sha256.update(words, starts[i], starts[Math.min(i + k, n)] - 1 - starts[i]);
            found[i] = first(sha256.digest());
        }
        Arrays.sort(found);
        int distinct = 1;
        for (int i = 1; i < found.length; i++) if (found[i] != found[i - 1]) found[distinct++] = found[i];
        return Arrays.copyOf(found, distinct);
    }

    public Object call(Object words, Object k, Object permutations) throws Exception {
        MessageDigest sha256 = MessageDigest.getInstance("SHA-256");
        long[] keys = keys((byte[]) words, ((Integer) k).intValue(), sha256);
        int n = ((Integer) permutations).intValue();
        long[] out = new long[1 + n];
        Arrays.fill(out, 0xFFFFFFFFL);
        out[0] = keys.length;
        if (keys.length > 0) HASHES.least(keys, n, out);
        return out;
    }
}

final class Digests implements Hashes {
    private static final byte[] DIGITS = "0123456789abcdef".getBytes();

    public void least(long[] keys, int n, long[] out) throws Exception {
        MessageDigest sha256 = MessageDigest.getInstance("SHA-256");
        byte[][] messages = new byte[n][];
        for (int i = 0; i < n; i++) messages[i] = (i + ":00000000").getBytes();
        byte[] key = new byte[8];
        byte[] hash = new byte[32];
        for (int at = 0; at < keys.length; at++) {
            for (int digit = 0; digit < 8; digit++) key[digit] = DIGITS[(int) (keys[at] >>> 28 - 4 * digit) & 15];
            for (int i = 0; i < n; i++) {
                byte[] message = messages[i];
                System.arraycopy(key, 0, message, message.length - 8, 8);
                sha256.update(message, 0, message.length);
                sha256.digest(hash, 0, 32);
                out[1 + i] = Math.min(out[1 + i], TextSignature.first(hash));
            }
        }
    }
}
"""
#: The same, as many keys at once as a vector holds; each message is one block of sha256. Vector calls stand in two methods, as
#: the JVM stops to inline helpers in long ones. Only Java's own compiler makes calls that it can inline.
_LANES = """
package corvane;

import java.util.Arrays;
import jdk.incubator.vector.IntVector;
import jdk.incubator.vector.VectorOperators;
import jdk.incubator.vector.VectorSpecies;

final class Lanes implements Hashes {
    private static final VectorSpecies<Integer> S = IntVector.SPECIES_PREFERRED;
    private static final int N = S.length();
    private static final int[] START = {%s};
    private static final int[] ROUND = {%s};

    private static IntVector turn(IntVector x, int n) {
        return x.lanewise(VectorOperators.LSHR, n).or(x.lanewise(VectorOperators.LSHL, 32 - n));
    }

    private static void extend(int[] w) {
        for (int at = 16 * N; at < 64 * N; at += N) {
            IntVector x = IntVector.fromArray(S, w, at - 15 * N), y = IntVector.fromArray(S, w, at - 2 * N);
            IntVector s0 = turn(x, 7).lanewise(VectorOperators.XOR, turn(x, 18)).lanewise(VectorOperators.XOR, x.lanewise(VectorOperators.LSHR, 3));
            IntVector s1 = turn(y, 17).lanewise(VectorOperators.XOR, turn(y, 19)).lanewise(VectorOperators.XOR, y.lanewise(VectorOperators.LSHR, 10));
            IntVector.fromArray(S, w, at - 16 * N).add(IntVector.fromArray(S, w, at - 7 * N)).add(s0).add(s1).intoArray(w, at);
        }
    }

    private static void rounds(int[] w, int[] out) {
        IntVector a = IntVector.broadcast(S, START[0]), b = IntVector.broadcast(S, START[1]), c = IntVector.broadcast(S, START[2]), d = IntVector.broadcast(S, START[3]);
        IntVector e = IntVector.broadcast(S, START[4]), f = IntVector.broadcast(S, START[5]), g = IntVector.broadcast(S, START[6]), h = IntVector.broadcast(S, START[7]);
        for (int at = 0; at < 64; at++) {
            IntVector s1 = turn(e, 6).lanewise(VectorOperators.XOR, turn(e, 11)).lanewise(VectorOperators.XOR, turn(e, 25));
            IntVector ch = g.lanewise(VectorOperators.XOR, e.and(f.lanewise(VectorOperators.XOR, g)));
            IntVector t = h.add(IntVector.fromArray(S, w, at * N)).add(ROUND[at]).add(s1).add(ch);
            IntVector s0 = turn(a, 2).lanewise(VectorOperators.XOR, turn(a, 13)).lanewise(VectorOperators.XOR, turn(a, 22));
            IntVector maj = a.and(b).or(c.and(a.or(b)));
            h = g;
            g = f;
            f = e;
            e = d.add(t);
            d = c;
            c = b;
            b = a;
            a = t.add(s0).add(maj);
        }
        a.add(START[0]).intoArray(out, 0);
    }

    private static int digits(long half) {
        int out = 0;
        for (int shift = 12; shift >= 0; shift -= 4) {
            int digit = (int) (half >>> shift) & 15;
            out = out << 8 | (digit < 10 ? '0' + digit : 'a' - 10 + digit);
        }
        return out;
    }

    /** The words of prefix + key, its end mark and its length, one key a lane. */
    private static void message(byte[] prefix, int[] high, int[] low, int[] w) {
        int whole = prefix.length / 4, bits = 8 * (prefix.length %% 4), begun = 0;
        Arrays.fill(w, 0, 15 * N, 0);
        for (int at = 0; at < prefix.length; at++) {
            begun = begun << 8 | prefix[at];
            if (at %% 4 == 3) {
                Arrays.fill(w, at / 4 * N, at / 4 * N + N, begun);
                begun = 0;
            }
        }
        for (int l = 0, at = whole * N; l < N; l++, at++) {
            w[at] = bits == 0 ? high[l] : begun << 32 - bits | high[l] >>> bits;
            w[at + N] = bits == 0 ? low[l] : high[l] << 32 - bits | low[l] >>> bits;
            w[at + 2 * N] = bits == 0 ? 0x80000000 : low[l] << 32 - bits | 0x80 << 24 - bits;
        }
        Arrays.fill(w, 15 * N, 16 * N, 8 * (prefix.length + 8));
    }

    public void least(long[] keys, int n, long[] out) {
        int[] w = new int[64 * N], high = new int[N], low = new int[N], hashes = new int[N];
        byte[][] prefixes = new byte[n][];
        for (int i = 0; i < n; i++) prefixes[i] = (i + ":").getBytes();
        for (int first = 0; first < keys.length; first += N) {
            for (int l = 0; l < N; l++) {
                long key = keys[Math.min(first + l, keys.length - 1)];
                high[l] = digits(key >>> 16);
                low[l] = digits(key);
            }
            for (int i = 0; i < n; i++) {
                message(prefixes[i], high, low, w);
                extend(w);
                rounds(w, hashes);
                for (int l = 0; l < N; l++) out[1 + i] = Math.min(out[1 + i], hashes[l] & 0xFFFFFFFFL);
            }
        }
    }
}
""" % tuple(", ".join(map(str, np.array(words, np.uint32).view(np.int32))) for words in (_START, _ROUND))

#: By application: the compiled function, and the folder of its jar, which goes with the driver.
_made: dict[str, tuple] = {}


def can_compile(spark: SparkSession) -> bool:
    return isinstance(spark._jvm.org.codehaus.janino.SimpleCompiler, JavaClass)


def _compile_lanes(spark: SparkSession, classes: Path) -> None:
    """Adds Lanes where the driver has Java's compiler and the module of vectors, which Spark's launchers add; else digests serve."""
    jvm = spark._jvm
    if not isinstance(jvm.com.sun.tools.javac.Main, JavaClass) or not jvm.java.lang.ModuleLayer.boot().findModule("jdk.incubator.vector").isPresent():
        return
    source = classes.parent / "Lanes.java"
    source.write_text(_LANES)
    said = jvm.java.io.StringWriter()
    words = ["-cp", str(classes), "-d", str(classes), "--add-modules", "jdk.incubator.vector", str(source)]
    arguments = spark.sparkContext._gateway.new_array(jvm.java.lang.String, len(words))
    for at, word in enumerate(words):
        arguments[at] = word
    if jvm.com.sun.tools.javac.Main.compile(arguments, jvm.java.io.PrintWriter(said)) != 0:
        raise RuntimeError(f"Lanes.java: {said.toString()}")


def _function(spark: SparkSession):
    context = spark.sparkContext
    if context.applicationId not in _made:
        compiler = spark._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.cook(_SOURCE)
        folder = tempfile.TemporaryDirectory()
        classes, jar = Path(folder.name) / "classes", Path(folder.name) / "corvane-text-signature.jar"
        (classes / "corvane").mkdir(parents=True)
        codes = compiler.getBytecodes()
        for name in codes:
            (classes / f"{name.replace('.', '/')}.class").write_bytes(bytes(codes[name]))
        _compile_lanes(spark, classes)
        with zipfile.ZipFile(jar, "w") as archive:
            for file in sorted(classes.rglob("*.class")):
                archive.write(file, str(file.relative_to(classes)))
        context._jsc.addJar(str(jar))
        none = [context._gateway.new_array(kind, 0) for kind in (spark._jvm.java.lang.Class, spark._jvm.java.lang.Object)]
        function = compiler.getClassLoader().loadClass(_CLASS).getDeclaredConstructor(none[0]).newInstance(none[1])
        _made[context.applicationId] = function, folder
    return _made[context.applicationId][0]


def text_signature(spark: SparkSession, words: Column, k: int, permutations: int) -> Column:
    """Array of the number of distinct k-grams of words that byte 31 joins, and their `vectors.minhash`."""
    kind = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(ArrayType(LongType(), False).json())
    spark._jsparkSession.udf().register(NAME, _function(spark), kind)
    return F.call_function(NAME, words.cast("binary"), F.lit(k), F.lit(permutations))
